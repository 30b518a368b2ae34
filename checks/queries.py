"""The registered queries: every operator over all derived deliveries.

Deliveries are written once per session and scale to the shared folder, in their physical formats, and
all queries read them from there. The stages several queries build on are kept next to them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import fixture
from feedgate.functions.columns import delivery_key
from feedgate.operators import disposition, identity, measures, reconcile, staging, versions
from feedgate.operators.gate import gate_reasons
from feedgate.plans import build as full_build
from feedgate.plans.feed import FeedPlan
from feedgate.plans.workspace import Workspace, fit_partitions
from feedgate.sinks import catalog, tables
from feedgate.sources import arrivals
from feedgate.sources import deliveries as source
from feedgate.sources.inventory import inventory_files

DATABASE = "feedgate_checks"
RUN_TIME = "2025-12-31 00:00:00"


@dataclass
class Feed:
    """The derived deliveries of one scale and the plan over them."""

    deliveries: list[source.Delivery]
    graph: str
    work: Workspace
    plan: FeedPlan
    drifted: list[source.Delivery] = field(default_factory=list)
    arrivals: arrivals.Arrivals | None = None
    extended: FeedPlan | None = None


_feeds: dict[tuple[str, str], Feed] = {}


def feed(spark: SparkSession, sf_dir: str) -> Feed:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _feeds:
        work = Workspace(spark, "checks", compression="zstd")
        fit_partitions(spark, fixture.line_count(spark, sf_dir))
        written, graph = fixture.write_deliveries(spark, sf_dir, work.path("deliveries"))
        plan = FeedPlan(
            staged=source.read_feed(spark, written),
            graph=source.read_dimension(spark, graph),
            expected=source.expected_deliveries(spark, written),
            contract=fixture.contract(spark, sf_dir),
            keep=work.keep,
            ingested_at=F.lit(RUN_TIME).cast("timestamp"),
        )
        _feeds[key] = Feed(written, graph, work, plan)
    return _feeds[key]


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so that both engines hand over the same values."""

    def plain(of: T.StructField):
        if isinstance(of.dataType, T.DecimalType):
            return F.col(of.name).cast("double").alias(of.name)
        if isinstance(of.dataType, T.DateType):
            return F.col(of.name).cast("string").alias(of.name)
        return F.col(of.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def published(df: DataFrame) -> DataFrame:
    return portable(df.drop("_ingested_at"))


Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}


def query(function: Callable[[Feed], DataFrame]) -> Callable[[Feed], DataFrame]:
    """Register a query under the name of its function, without a trailing underscore."""
    _queries[function.__name__.rstrip("_")] = lambda spark, sf_dir: function(feed(spark, sf_dir))
    return function


def queries() -> dict[str, Query]:
    return dict(_queries)


KEYS = ["claim_id", "claim_line"]


def _spark(f: Feed) -> SparkSession:
    return f.work.spark


# Sources


@query
def delivery_key_(f: Feed) -> DataFrame:
    found = delivery_key(F.col("_source_file")).alias("delivery_month")
    return f.plan.staged.groupBy("_source_file", found).agg(F.count(F.lit(1)).alias("line_count"))


@query
def physical_format(f: Feed) -> DataFrame:
    typed = staging.normalize(f.plan.staged, f.plan.contract)
    return typed.groupBy("_physical_format").agg(F.count(F.lit(1)).alias("line_count"))


@query
def lineage(f: Feed) -> DataFrame:
    return f.plan.staged.select(*KEYS, "_delivery_month", "_source_file")


def _scan(f: Feed, delimited: bool) -> DataFrame:
    chosen = [d for d in f.deliveries if d.is_delimited == delimited]
    return source.read_feed(_spark(f), chosen).select(*f.plan.contract.columns, "_source_file")


@query
def scan_csv(f: Feed) -> DataFrame:
    return _scan(f, delimited=True)


@query
def scan_parquet(f: Feed) -> DataFrame:
    return _scan(f, delimited=False)


def drifted(f: Feed) -> list[source.Delivery]:
    """Every delivery written anew: Parquet parts that differ in columns, types and case; text with line breaks.

    One kind of Parquet part holds the code as a number under an upper-case name, one as text, one not at all.
    Delimited deliveries have their columns reversed, in upper case, and a quoted line break in a note.
    """
    if f.drifted:
        return f.drifted
    for d in f.deliveries:
        sent = source.Delivery(f"{f.work.path('drift')}/{d.name}", multiline=d.is_delimited)
        lines = f.plan.staged.where(F.col("_delivery_month") == d.month).select(*f.plan.contract.columns)
        if d.is_delimited:
            noted = lines.withColumn("vendor_note", F.concat_ws("\n", F.lit("line"), "claim_line"))
            upper = noted.select(*[F.col(c).alias(c.upper()) for c in reversed(noted.columns)])
            upper.write.mode("overwrite").csv(sent.path, sep="|", header=True, escape='"')
        else:
            numbered = lines.where("claim_type = 'PROF'").withColumn("npi", F.col("npi").cast("int"))
            numbered.withColumnRenamed("npi", "NPI").write.mode("overwrite").parquet(sent.path)
            rest = lines.where("claim_type <> 'PROF'")
            rest.where("gender = 'M'").write.mode("append").parquet(sent.path)
            rest.where("gender <> 'M'").drop("npi").write.mode("append").parquet(sent.path)
        f.drifted.append(sent)
    return f.drifted


@query
def drifting_parts(f: Feed) -> DataFrame:
    read = source.read_feed(_spark(f), drifted(f))
    return read.select(*[F.col(c).alias(c) for c in (*f.plan.contract.columns, "vendor_note")], "_source_file")


def _headed(header: str):
    def run(parts):
        yield pd.DataFrame({"value": [header]})
        yield from parts

    return run


def damaged(f: Feed) -> arrivals.Arrivals:
    """The feed with broken deliveries: one lacks a required column, one is no Parquet, one has rows with a field too many."""
    if f.arrivals is None:
        columns, sent = f.plan.contract.columns, []
        for d in f.deliveries:
            lines = f.plan.staged.where(F.col("_delivery_month") == d.month).select(*columns)
            broken = source.Delivery(f"{f.work.path('damaged')}/{d.name}")
            if d.month == "2025-02":
                lines.drop("charge_amount").write.parquet(broken.path)
            elif d.month == "2025-05":
                lines.select(F.col("claim_id").alias("value")).write.text(broken.path)
            elif d.month == "2025-09":
                row = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in columns])
                surplus = F.when(F.col("claim_line") == "7", F.lit("|EXTRA")).otherwise("")
                text = lines.select(F.concat(row, surplus).alias("value")).repartition(3)
                text.mapInPandas(_headed("|".join(columns)), "value string").write.text(broken.path)
            else:
                broken = d
            sent.append(broken)
        f.arrivals = arrivals.receive(_spark(f), sent, f.plan.contract, f.work.keep)
    return f.arrivals


@query
def rejected_rows(f: Feed) -> DataFrame:
    """Rows with a field too many, as they were sent."""
    return damaged(f).rejected.select("_delivery_month", "_source_file", "record")


@query
def isolated_decisions(f: Feed) -> DataFrame:
    """Three broken deliveries block themselves; the gate decides on the others."""
    found = damaged(f)
    plan = FeedPlan(
        staged=found.staged(f.plan.contract),
        graph=f.plan.graph,
        expected=f.plan.expected,
        contract=f.plan.contract,
        keep=lambda name, df, partition=None: f.work.keep(f"isolated_{name}", df, partition),
        ingested_at=f.plan.ingested_at,
        issues=found.issues,
    )
    return plan.decisions.drop("all_reasons")


@query
def scan_tokens(f: Feed) -> DataFrame:
    return source.read_dimension(_spark(f), f.graph)


@query
def inventory(f: Feed) -> DataFrame:
    """Without the byte size, which depends on the writer."""
    listed = inventory_files(_spark(f), source.open_feed(_spark(f), f.deliveries))
    return listed.withColumn("s3_key", F.element_at(F.split("s3_key", "/"), -1)).drop("size_bytes")


@query
def expected_deliveries(f: Feed) -> DataFrame:
    """The calendar against what arrived."""
    arrived = f.plan.staged.groupBy(F.col("_delivery_month").alias("delivery_month")).agg(F.count(F.lit(1)).alias("n"))
    calendar = source.expected_deliveries(_spark(f), f.deliveries)
    lines = F.coalesce("n", F.lit(0)).alias("line_count")
    return calendar.join(arrived, "delivery_month", "left").select("delivery_month", lines)


# Union and casts


@query
def union_by_name(f: Feed) -> DataFrame:
    """Integer codes in two deliveries; the first lacks a column and brings an extra one."""
    frames = [source.read_delivery(_spark(f), d) for d in f.deliveries]
    note = F.concat_ws(" ", F.lit("note"), "claim_line")
    frames[0] = frames[0].drop("allowed_amount").withColumn("vendor_note", note)
    return staging.union_deliveries(frames)


@query
def normalize(f: Feed) -> DataFrame:
    return portable(staging.normalize(f.plan.staged, f.plan.contract))


@query
def row_hash(f: Feed) -> DataFrame:
    return f.plan.normalized.select(*KEYS, "_delivery_month", "_row_hash")


# Identity


@query
def token_resolve(f: Feed) -> DataFrame:
    return identity.resolve_tokens(f.plan.graph)


@query
def attach_identity(f: Feed) -> DataFrame:
    attached = identity.attach_identity(f.plan.normalized, f.plan.decisions, f.plan.tokens)
    return attached.select(
        *KEYS, "_delivery_month", "_row_hash", "vi_pid", "_token_ambiguous", "_token_unresolved"
    )


@query
def token_vi_ambiguous(f: Feed) -> DataFrame:
    return identity.token_vi_ambiguous(f.plan.tokens)


@query
def token_patient_ambiguous(f: Feed) -> DataFrame:
    return identity.token_patient_ambiguous(f.plan.normalized)


@query
def token_resolution_rate(f: Feed) -> DataFrame:
    return identity.token_resolution_rate(f.plan.normalized, f.plan.tokens)


# Measures and gate


@query
def contract_measures(f: Feed) -> DataFrame:
    return measures.contract_measures(f.plan.identified, f.plan.contract)


@query
def volume_band(f: Feed) -> DataFrame:
    measured = measures.contract_measures(f.plan.identified, f.plan.contract)
    return measures.volume_band(measured, f.plan.contract)


@query
def global_key_dupes(f: Feed) -> DataFrame:
    return measures.global_key_dupes(f.plan.identified, f.plan.contract)


@query
def same_delivery_conflicts(f: Feed) -> DataFrame:
    return measures.same_delivery_conflicts(f.plan.identified, f.plan.contract)


@query
def gate_reasons_(f: Feed) -> DataFrame:
    reasons = gate_reasons(f.plan.expected, f.plan.results, f.plan.conflicts)
    return reasons.select(
        "_delivery_month",
        "total_rows",
        F.array_join("all_reasons", "|").alias("reason_codes"),
        F.size("all_reasons").cast("bigint").alias("reason_count"),
    )


@query
def promotion_decisions(f: Feed) -> DataFrame:
    return f.plan.decisions.drop("all_reasons")


# Disposition


@query
def row_warnings(f: Feed) -> DataFrame:
    codes = disposition.warning_codes(f.plan.contract).alias("warnings")
    return f.plan.accepted.select(*KEYS, "_delivery_month", "_row_hash", codes)


@query
def row_disposition(f: Feed) -> DataFrame:
    """With the conflict join, which the gate makes redundant under the default block codes."""
    graded = disposition.row_disposition(f.plan.accepted, f.plan.contract, f.plan.conflicts)
    return graded.select(*KEYS, "_delivery_month", "_row_hash", "_dq_status", "_dq_reasons")


@query
def quarantine(f: Feed) -> DataFrame:
    return published(disposition.quarantine(f.plan.held, f.plan.contract, f.plan.ingested_at))


def extended(f: Feed) -> FeedPlan:
    """The feed with text that fits no type and lines without claim, under extended warnings; conflicts do not block."""
    if f.extended is None:
        blocking = tuple(r for r in f.plan.contract.blocking_reasons if r != "SAME_MONTH_CONFLICT")
        spoilt = {
            "claim_id": F.expr("if(claim_line = '6', NULL, claim_id)"),
            "allowed_amount": F.expr("if(claim_line = '5', 'n/a', allowed_amount)"),
            "paid_date": F.expr("if(claim_line = '4', ' ', paid_date)"),
            "units": F.expr("if(claim_line = '3', 'one', units)"),
        }
        f.extended = FeedPlan(
            staged=f.plan.staged.withColumns(spoilt),
            graph=f.plan.graph,
            expected=f.plan.expected,
            contract=replace(f.plan.contract, extended_warnings=True, blocking_reasons=blocking),
            keep=lambda name, df, partition=None: f.work.keep(f"extended_{name}", df, partition),
            ingested_at=f.plan.ingested_at,
        )
    return f.extended


@query
def cast_failures(f: Feed) -> DataFrame:
    return measures.cast_failures(extended(f).identified, extended(f).contract)


@query
def extended_disposition(f: Feed) -> DataFrame:
    """Failed casts, repeated keys and tokens of several patients as warnings; conflicts held line by line."""
    return extended(f).disposed.select(*KEYS, "_delivery_month", "_row_hash", "_dq_status", "_dq_reasons")


@query
def extended_reconciliation(f: Feed) -> DataFrame:
    return extended(f).reconciliation


@query
def incomplete_keys(f: Feed) -> DataFrame:
    """Lines without claim share a key: which of them are replays, and which are lost to another line."""
    return extended(f).incomplete_keys


# Versions


@query
def dedup_rank(f: Feed) -> DataFrame:
    return versions.dedup_rank(f.plan.eligible, f.plan.contract)


@query
def replays(f: Feed) -> DataFrame:
    return versions.replays(f.plan.eligible, f.plan.contract)


@query
def version_rank(f: Feed) -> DataFrame:
    """Over a written table, as the ranking reads its input twice."""
    earliest = f.work.keep("earliest", f.plan.earliest)
    return versions.version_rank(earliest, f.plan.contract).drop("_line_id", "_replaces")


@query
def silver_line(f: Feed) -> DataFrame:
    return published(f.plan.silver_lines)


@query
def net_charge(f: Feed) -> DataFrame:
    return portable(reconcile.net_charge(f.plan.silver))


# Header, reconciliation and reports


@query
def claim_header(f: Feed) -> DataFrame:
    return published(f.plan.headers)


@query
def reconciliation(f: Feed) -> DataFrame:
    return f.plan.reconciliation


def _seeded(checked: Callable[[DataFrame], DataFrame], table: DataFrame, broken: DataFrame) -> DataFrame:
    """What a check finds in the table as built, and in one with violations put in."""
    found = checked(broken).withColumn("checked", F.lit("seeded"))
    return checked(table).withColumn("checked", F.lit("built")).unionByName(found)


@query
def reconciliation_failures(f: Feed) -> DataFrame:
    """Seeded: one more delivered row wherever copies were dropped."""
    counted = f.plan.reconciliation
    lost = F.when(F.col("deduplicated_rows") > 0, 1).otherwise(0)
    return _seeded(reconcile.reconciliation_failures, counted, counted.withColumn("raw_rows", F.col("raw_rows") + lost))


@query
def grain_delivered(f: Feed) -> DataFrame:
    return reconcile.grain_violations(f.plan.identified, KEYS)


@query
def grain_line(f: Feed) -> DataFrame:
    """Seeded: replacement lines twice."""
    lines = f.plan.silver.select(*KEYS, "claim_freq_code")
    twice = lines.unionByName(lines.where("claim_freq_code = '7'"))
    return _seeded(lambda df: reconcile.grain_violations(df, KEYS), lines, twice)


@query
def grain_header(f: Feed) -> DataFrame:
    """Seeded: headers with warnings twice."""
    headers = f.plan.headers.select("claim_id", "_dq_status")
    twice = headers.unionByName(headers.where("_dq_status = 'WARN'"))
    return _seeded(lambda df: reconcile.grain_violations(df, ["claim_id"]), headers, twice)


@query
def decision_report(f: Feed) -> DataFrame:
    return reconcile.decision_report(f.plan.decisions.drop("all_reasons"), f.plan.results)


@query
def run_totals(f: Feed) -> DataFrame:
    return portable(f.plan.totals)


@query
def replay_check(f: Feed) -> DataFrame:
    """Two full builds from the same files, with their totals side by side."""
    totals = [
        full_build.build(
            _spark(f), f.deliveries, f.graph, Workspace(_spark(f), run).path("out"), f.plan.contract
        )
        .totals()
        .withColumn("run", F.lit(run))
        for run in ("first", "second")
    ]
    return portable(reduce(DataFrame.unionByName, totals))


# Sinks


@query
def sink_roundtrip(f: Feed) -> DataFrame:
    path = f.work.path("sink_roundtrip")
    tables.write_partitioned(f.plan.silver, path)
    return published(_spark(f).read.parquet(path))


@query
def audit_roundtrip(f: Feed) -> DataFrame:
    path = f.work.path("audit_roundtrip")
    tables.write_audit(f.plan.results, path)
    return _spark(f).read.parquet(path)


def _database(f: Feed) -> str:
    folder = f.work.path("database")
    _spark(f).sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION '{folder}'")
    return DATABASE


@query
def catalog_table(f: Feed) -> DataFrame:
    """All partitions of the three published tables, as the catalog discovers them."""
    published_tables = {
        "silver_claim_line": (f.plan.silver, "is_current", "charge_amount"),
        "silver_claim_line_quarantine": (f.plan.quarantine, "is_current", "charge_amount"),
        "silver_claim_header": (f.plan.headers, "all_lines_current", "total_charge_amount"),
    }
    found = []
    for table, (rows, current, amount) in published_tables.items():
        name, path = f"{_database(f)}.{table}", f.work.path(f"catalog_{table}")
        tables.write_partitioned(rows, path)
        catalog.register_table(_spark(f), name, path, rows)
        found.append(_spark(f).sql(f"""
            SELECT '{table}' AS table_name, _delivery_month, count(*) AS row_count,
                   count_if({current}) AS current_rows, cast(sum({amount}) AS double) AS charge
            FROM {name} GROUP BY _delivery_month"""))
    return reduce(DataFrame.unionByName, found)


@query
def catalog_audit(f: Feed) -> DataFrame:
    """The four audit tables as the catalog reads them, the reasons from their array column."""
    details = {
        "inventory": (inventory_files(_spark(f), source.open_feed(_spark(f), f.deliveries)), "file_format"),
        "validation_results": (f.plan.results, "clause_2_3"),
        "promotion_decisions": (f.plan.decisions, "array_join(all_reasons, '|')"),
        "reconciliation": (f.plan.reconciliation, "decision"),
    }
    found = []
    for table, (rows, detail) in details.items():
        name, path = f"{_database(f)}.{table}", f.work.path(f"catalog_{table}")
        tables.write_audit(rows, path)
        catalog.register_audit(_spark(f), name, path, rows)
        month = "delivery_month" if table == "inventory" else "_delivery_month"
        found.append(_spark(f).sql(f"SELECT '{table}' AS table_name, {month} AS delivery_month, {detail} AS detail FROM {name}"))
    return reduce(DataFrame.unionByName, found)


@query
def catalog_raw(f: Feed) -> DataFrame:
    names = catalog.register_raw(_spark(f), _database(f), f.deliveries, f.graph)
    counts = [
        _spark(f).table(n).agg(F.lit(n.split(".")[1]).alias("table_name"), F.count(F.lit(1)).alias("line_count"))
        for n in names
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def catalog_drift(f: Feed) -> DataFrame:
    """All rows and columns of the drifting deliveries, through the catalog."""
    folder = f.work.path("drift_database")
    database = f"{DATABASE}_drift"
    _spark(f).sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")
    sent = drifted(f)
    names = catalog.register_raw(_spark(f), database, sent, f.graph)
    read = [source.with_lineage(_spark(f).table(name), d) for name, d in zip(names, sent, strict=False)]
    rows = staging.union_deliveries(read)
    return rows.select(*[F.col(c).alias(c) for c in (*f.plan.contract.columns, "vendor_note")], "_source_file")
