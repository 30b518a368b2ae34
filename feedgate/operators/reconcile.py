"""Prove that every accepted row is accounted for, and report on a build."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedgate.contract import FeedContract
from feedgate.operators.versions import DROPPED, earliest_copies


def reconciliation(
    decisions: DataFrame, held: DataFrame, excepted: DataFrame, silver: DataFrame
) -> DataFrame:
    """Rows of each delivery by outcome.

    Quarantined, dropped and published lines are counted from three tables; a line lost or multiplied
    between them shows up as a difference. Broadcast sides hold a row per delivery.
    """

    def per_delivery(rows: DataFrame, name: str) -> DataFrame:
        return F.broadcast(rows.groupBy("_delivery_month").agg(F.count(F.lit(1)).alias(name)))

    parts = {
        "quarantine_rows": held.where(F.col("_held_for").isNotNull()),
        "deduplicated_rows": excepted.where(F.col("_exception") == DROPPED),
        "silver_eligible_rows": silver,
    }
    joined = decisions
    for name, rows in parts.items():
        joined = joined.join(per_delivery(rows, name), "_delivery_month", "left")
    return joined.select(
        "_delivery_month",
        "decision",
        F.col("total_rows").alias("raw_rows"),
        *[F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name) for name in parts],
    )


def incomplete_keys(slim: DataFrame, latest: DataFrame, contract: FeedContract) -> DataFrame:
    """Eligible lines of each delivery without a complete key, and what became of them.

    Such lines share one key, so they replace each other: ``replayed_rows`` repeat content of an earlier copy, but
    ``collapsed_rows`` are different lines that are lost to the one that was kept. Copies are found by content, which
    spreads the lines of the shared key, and all three tables are counted in one aggregation.
    """
    partial = reduce(Column.__or__, [F.col(c).isNull() for c in contract.line_key])

    def counted(rows: DataFrame, sent: int, distinct: int, kept: int) -> DataFrame:
        marks = {"_sent": sent, "_distinct": distinct, "_kept": kept}
        return rows.select("_delivery_month", *[F.lit(v).alias(name) for name, v in marks.items()])

    lines = slim.where(partial)
    every = (
        counted(lines, 1, 0, 0)
        .unionByName(counted(earliest_copies(lines, contract), 0, 1, 0))
        .unionByName(counted(latest.where(partial), 0, 0, 1))
    )
    return every.groupBy("_delivery_month").agg(
        F.sum("_sent").alias("incomplete_rows"),
        (F.sum("_sent") - F.sum("_distinct")).alias("replayed_rows"),
        (F.sum("_distinct") - F.sum("_kept")).alias("collapsed_rows"),
    )


def reconciliation_failures(reconciled: DataFrame) -> DataFrame:
    explained = F.col("silver_eligible_rows") + F.col("quarantine_rows") + F.col("deduplicated_rows")
    return reconciled.where((F.col("decision") != "BLOCK") & (F.col("raw_rows") != explained))


def grain_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once."""
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows_at_grain")).where(F.col("rows_at_grain") > 1)
    )


def decision_report(decisions: DataFrame, results: DataFrame) -> DataFrame:
    """Decisions with the measurements that support them, in calendar order."""
    support = results.select(
        "_delivery_month", "dx_populated", "npi_populated", "token_resolution_rate"
    )
    return decisions.join(F.broadcast(support), "_delivery_month", "left").orderBy("_delivery_month")


def run_totals(silver: DataFrame, quarantined: DataFrame) -> DataFrame:
    """One row: published lines, current lines, current charges, quarantined lines.

    Both sides are tagged and summed in one aggregation.
    """
    money = T.DecimalType(38, 2)
    published = silver.select(
        F.lit(1).alias("_line"),
        F.col("is_current").cast("int").alias("_current"),
        F.when(F.col("is_current"), F.col("charge_amount")).alias("_charge"),
        F.lit(0).alias("_held"),
    )
    held = quarantined.select(
        F.lit(0).alias("_line"),
        F.lit(0).alias("_current"),
        F.lit(None).cast(T.DecimalType(12, 2)).alias("_charge"),
        F.lit(1).alias("_held"),
    )
    return published.unionByName(held).agg(
        F.coalesce(F.sum("_line"), F.lit(0)).cast("bigint").alias("silver_lines"),
        F.coalesce(F.sum("_current"), F.lit(0)).cast("bigint").alias("current_lines"),
        F.sum("_charge").cast(money).alias("total_charge"),
        F.coalesce(F.sum("_held"), F.lit(0)).cast("bigint").alias("quarantine_lines"),
    )


def net_charge(silver: DataFrame) -> DataFrame:
    """Current charges per frequency code: reversals stay and offset what they reverse."""
    return (
        silver.where("is_current")
        .groupBy("claim_freq_code")
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum("charge_amount").cast(T.DecimalType(38, 2)).alias("net_charge"),
        )
    )


def replay_differences(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows that differ between two builds of the same deliveries, ignoring the run timestamp."""
    before = first.drop("_ingested_at")
    after = second.select(*before.columns)
    tagged = before.withColumn("_builds", F.lit(1)).unionByName(after.withColumn("_builds", F.lit(-1)))
    return (
        tagged.groupBy(*before.columns)
        .agg(F.sum("_builds").alias("surplus"))
        .where(F.col("surplus") != 0)
    )
