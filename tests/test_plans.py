"""The physical plans keep their shape: few shuffles, hot groups split, filters pushed down."""

from __future__ import annotations

import pytest
from conftest import collected, explained
from pyspark.sql import functions as F

from feedgate import FeedContract
from feedgate.operators import disposition, identity, measures, reconcile, versions
from feedgate.plans.workspace import Workspace

LINES = 4_000


@pytest.fixture(scope="module")
def hot(spark):
    """Eligible lines of which a third are copies of one line, in four deliveries."""
    hot_line = F.col("id") % 3 == 0
    claim = F.when(hot_line, F.lit("HOT")).otherwise(F.concat(F.lit("C"), F.col("id").cast("string")))
    lines = spark.range(0, LINES, 1, 8).select(
        claim.alias("claim_id"),
        F.lit(1).alias("claim_line"),
        F.md5(claim).alias("_row_hash"),
        F.concat(F.lit("2025-0"), (F.col("id") % 4 + 1).cast("string")).alias("_delivery_month"),
        F.lit("1").alias("claim_freq_code"),
        F.lit(None).cast("string").alias("original_claim_id"),
        F.when(hot_line, F.lit("T-HOT")).otherwise(F.concat(F.lit("T"), F.col("id").cast("string"))).alias("member_token"),
    )
    return Workspace(spark, "hot").keep("lines", versions.with_line_id(lines))


def exchanges(plan: str) -> int:
    tree = plan.split("\n\n\n")[0]
    return tree.count("Exchange (") - tree.count("BroadcastExchange (")


def test_copies_are_limited_before_the_shuffle(spark, hot):
    contract = FeedContract()
    slim = versions.slim_versions(hot, contract)
    plan = explained(versions.latest_versions(versions.earliest_copies(slim, contract), contract))
    tree = plan.split("\n\n\n")[0]
    assert tree.count("WindowGroupLimit") == 4 and exchanges(plan) == 2
    scan = plan[plan.index("ReadSchema"):].split("\n")[0]
    assert "member_token" not in scan and "_row_hash" in scan


def test_hot_copies_are_ranked_whole(spark, hot, monkeypatch):
    monkeypatch.setattr(versions, "COPIES_PER_CHUNK", 100)
    ranked = versions.dedup_rank(hot, FeedContract())
    copies = sum(1 for i in range(LINES) if i % 3 == 0)
    found = ranked.where("claim_id = 'HOT'").agg(
        F.count("*"), F.min("dup_rank"), F.max("dup_rank"), F.countDistinct("dup_rank")
    ).first()
    assert tuple(found) == (copies, 1, copies, copies)
    assert ranked.count() == LINES
    replayed = versions.replays(hot, FeedContract()).agg(F.sum("replayed_rows")).first()[0]
    assert replayed == copies - 1


def test_versions_of_a_hot_key_are_ranked_whole(spark):
    rows = spark.range(0, LINES).select(
        F.lit("HOT").alias("claim_id"),
        F.lit(None).cast("int").alias("claim_line"),
        F.md5(F.col("id").cast("string")).alias("_row_hash"),
        F.concat(F.lit("2025-0"), (F.col("id") % 4 + 1).cast("string")).alias("_delivery_month"),
    )
    ranked = versions.version_rank(rows, FeedContract()).collect()
    order = sorted(ranked, key=lambda r: (r._delivery_month, r._row_hash), reverse=True)
    assert [r.version_rank for r in order] == list(range(1, LINES + 1))


@pytest.fixture
def unbroadcast(spark):
    """No room for a broadcast, and small partitions already count as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "6",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df) -> str:
    """The plan after adaptive execution has run it."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_tokens_are_split_in_the_join(spark, hot, unbroadcast):
    ids = spark.range(0, LINES).select(
        F.concat(F.lit("T"), F.col("id").cast("string")).alias("member_token"), F.lit("V").alias("vi_pid")
    )
    graph = ids.union(spark.sql("SELECT 'T-HOT', 'V-HOT'"))
    tokens = Workspace(spark, "tokens").keep("tokens", identity.resolve_tokens(graph))
    found = identity.identify(hot, tokens)
    assert found.where("_token_known").count() == LINES
    assert "skew=true" in final_plan(found)


def test_lines_of_a_hot_claim_are_split_in_the_join(spark, unbroadcast):
    latest = spark.range(0, LINES, 1, 8).select(
        F.col("id").alias("_line_id"),
        F.lit("2025-01").alias("_delivery_month"),
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("claim_id"),
        F.when(F.col("id") % 5 == 0, F.lit("HOT")).otherwise(F.lit(None)).alias("_replaces"),
    )
    work = Workspace(spark, "claims")
    latest = work.keep("latest", latest)
    replaced = work.keep("replaced", versions.replaced_claims(latest))
    found = versions.exceptions(latest, latest, replaced)
    assert {r._exception for r in found.collect()} == {"superseded"}
    assert found.count() == sum(1 for i in range(LINES) if i % 3 == 0)
    assert "skew=true" in final_plan(found)


def test_lines_of_a_hot_key_are_split_when_marked(spark, hot, unbroadcast):
    """Slim lines meet the issue table, wide lines only their own ids."""
    work = Workspace(spark, "marks")
    dupes = work.keep("dupes", hot.select("claim_id", "claim_line").distinct())
    found = disposition.line_marks(hot, FeedContract(), key_dupes=dupes)
    marks = work.keep("marks", found)
    assert marks.count() == LINES and marks.where(f"_marks <> {disposition.KEY_DUP}").isEmpty()
    assert "skew=true" in final_plan(found)


def test_consumers_of_marks_read_one_written_table(feed):
    rows = [{}, {"claim_id": "B"}, {"claim_id": "B", "units": "2"}]
    plan = feed(*rows, blocking_reasons=("EMPTY_DELIVERY",))
    for df in (plan.held, plan.slim, plan.quarantine_lines):
        text = explained(df)
        assert "/marks" in text and "/conflicts" not in text
    assert collected(plan.quarantine_lines, "claim_id", "_dq_reasons") == [("B", "SAME_MONTH_CONFLICT")] * 2
    assert feed(*rows).marks is None


def test_measures_take_one_shuffle(feed):
    plan = feed({})
    text = explained(measures.contract_measures(plan.identified, plan.contract))
    assert exchanges(text) == 1
    assert "claim_type" not in text[text.index("ReadSchema"):].split("\n")[0]


def test_conflicts_read_only_key_and_hash(feed):
    plan = feed({})
    text = explained(measures.same_delivery_conflicts(plan.identified, plan.contract))
    assert exchanges(text) == 1
    assert text[text.index("ReadSchema"):].split("\n")[0].count(":string") == 2
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


@pytest.mark.parametrize("stage", ["accepted", "held", "slim", "silver_lines"])
def test_blocked_deliveries_are_not_opened(feed, stage):
    plan = feed({}, {"claim_id": "B", "month": "2025-02"}, {"claim_id": "B", "month": "2025-02", "units": "2"})
    df = getattr(plan, stage)
    scan = explained(df)
    assert "PartitionFilters" in scan and "dynamicpruning" in scan[scan.index("PartitionFilters"):].split("\n")[0]
    assert {r._delivery_month for r in df.select("_delivery_month").collect()} == {"2025-01"}


def test_silver_needs_no_shuffle_when_exceptions_are_few(feed):
    plan = feed({}, {"claim_id": "B"})
    assert exchanges(explained(plan.silver_lines)) == 0


def test_quarantine_filter_reaches_the_scan(feed):
    plan = feed({})
    text = explained(plan.quarantine_lines)
    assert "_token_ambiguous" in text[text.index("PushedFilters"):].split("\n")[0]


def test_totals_are_one_aggregation(feed):
    plan = feed({})
    assert exchanges(explained(reconcile.run_totals(plan.silver, plan.quarantine))) == 1
