"""Collapse exact replays, keep the latest version of each line, mark replaced claims.

All ranking happens on slim rows (line id, key, hash, delivery, replaced claim). What comes back to the
full lines is only the list of exceptions: lines that are dropped or superseded. It is joined on the
unique line id, so the wide join has no hot key; Spark broadcasts it while its files are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedgate.contract import FeedContract
from feedgate.functions.columns import LINE_ID
from feedgate.functions.filters import candidates, others
from feedgate.functions.ranking import top_row
from feedgate.operators.disposition import grade

DROPPED = "dropped"
SUPERSEDED = "superseded"

# Copies numbered by one task of dedup_rank, and hash digits that split one key in version_rank.
COPIES_PER_CHUNK = 10_000
HASH_DIGITS = 3


def with_line_id(lines: DataFrame) -> DataFrame:
    """Give each line a unique number.

    The number depends on how Spark split the input, so the result has to be written before it is
    used twice.
    """
    return lines.withColumn(LINE_ID, F.monotonically_increasing_id())


def slim_versions(lines: DataFrame, contract: FeedContract) -> DataFrame:
    """What ranking needs to know about a line."""
    replaces = F.when(
        F.col("claim_freq_code") == contract.replacement_code, F.col("original_claim_id")
    )
    return lines.select(
        LINE_ID, *contract.line_key, "_row_hash", "_delivery_month", replaces.alias("_replaces")
    )


def packed(slim: DataFrame) -> DataFrame:
    """The row hash as the 16 bytes its digits stand for: in the same order, at half the length."""
    return slim.withColumn("_row_hash", F.unhex("_row_hash"))


def unpacked(slim: DataFrame) -> DataFrame:
    return slim.withColumn("_row_hash", F.lower(F.hex("_row_hash")))


def earliest_copies(slim: DataFrame, contract: FeedContract) -> DataFrame:
    """One row per key and content: the copy delivered first."""
    order = [F.col("_delivery_month").asc_nulls_last(), F.col(LINE_ID)]
    return top_row(slim, ["_row_hash", *contract.line_key], order)


def latest_versions(earliest: DataFrame, contract: FeedContract) -> DataFrame:
    """One row per key: the version delivered last, the higher hash deciding within a delivery."""
    order = [F.col("_delivery_month").desc_nulls_last(), F.col("_row_hash").desc_nulls_last()]
    return top_row(earliest, contract.line_key, order)


def latest_lines(slim: DataFrame, contract: FeedContract, recurring: DataFrame) -> DataFrame:
    """The latest version of each key, where only lines whose key may recur are ranked.

    ``recurring`` is the written filter of keys that several lines have (``recurring_filter``). It lets every line of
    such a key pass; a line without namesakes is its own latest version and stays where it is read.
    """
    key = list(contract.line_key)
    ranked = latest_versions(earliest_copies(packed(candidates(slim, recurring, key)), contract), contract)
    return others(slim, recurring, key).drop("_row_hash").unionByName(ranked.drop("_row_hash"))


def replaced_claims(latest: DataFrame) -> DataFrame:
    """Claims named by the latest version of some replacement line, each once."""
    named = latest.where(F.col("_replaces").isNotNull())
    return named.select(F.col("_replaces").alias("claim_id")).distinct()


def exceptions(
    slim: DataFrame,
    latest: DataFrame,
    replaced: DataFrame,
    recurring: tuple[DataFrame, Sequence[str]] | None = None,
    claims: DataFrame | None = None,
) -> DataFrame:
    """Eligible lines that are not plainly current, by line id: dropped or superseded.

    ``latest`` and ``replaced`` are best read from written tables: Spark then broadcasts a small one by
    its file size, and can split the partitions of a claim with very many lines otherwise, which it
    does not do right above an aggregation. The ids of ``latest`` are as many as the lines and are never broadcast,
    however well their files compress. With the filter of the keys that recur and those keys, and with the filter of the
    replaced claims, only lines that may be exceptions are shuffled.
    """
    several, kept = (slim, latest) if recurring is None else (candidates(df, *recurring) for df in (slim, latest))
    dropped = several.join(kept.select(LINE_ID).hint("merge"), LINE_ID, "left_anti")
    superseded = candidates(latest, claims, ["claim_id"]).join(replaced, "claim_id", "left_semi")

    def tagged(rows: DataFrame, reason: str) -> DataFrame:
        return rows.select(LINE_ID, "_delivery_month", F.lit(reason).alias("_exception"))

    return tagged(dropped, DROPPED).unionByName(tagged(superseded, SUPERSEDED))


def copies(lines: DataFrame, contract: FeedContract) -> DataFrame:
    """Rows per key, content and delivery; a heavily replayed line leaves each task as one count."""
    return lines.groupBy(*contract.line_key, "_row_hash", "_delivery_month").agg(
        F.count(F.lit(1)).alias("copies")
    )


def _numbered_copies(lines: DataFrame, contract: FeedContract) -> DataFrame:
    """Copies per delivery with the number of copies delivered before (one row per delivery)."""
    before = (
        Window.partitionBy("_row_hash", *contract.line_key)
        .orderBy(F.col("_delivery_month").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return copies(lines, contract).withColumn(
        "_before", F.coalesce(F.sum("copies").over(before), F.lit(0))
    )


def dedup_rank(lines: DataFrame, contract: FeedContract) -> DataFrame:
    """Number the copies of the same content from the earliest delivery on, one row per copy.

    Copies are interchangeable, so they are counted and then numbered in chunks. Where there are several, Spark
    spreads them over tasks; no task sorts or holds all copies of one line.
    """
    key = list(contract.line_key)
    size = F.lit(COPIES_PER_CHUNK).cast("bigint")
    last_chunk = F.floor((F.col("copies") - 1) / size)
    numbered = _numbered_copies(lines, contract)
    chunks = numbered.where(last_chunk > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk))
    )
    spread = (
        numbered.where(last_chunk == 0)
        .withColumn("_chunk", F.lit(0).cast("bigint"))
        .unionByName(chunks.repartition("_row_hash", *key, "_delivery_month", "_chunk"))
    )
    first = F.col("_chunk") * size + 1
    last = F.least(F.col("copies"), (F.col("_chunk") + 1) * size)
    return spread.withColumn("_copy", F.explode(F.sequence(first, last))).select(
        *key,
        "_row_hash",
        "_delivery_month",
        (F.col("_before") + F.col("_copy")).alias("dup_rank"),
    )


def replays(lines: DataFrame, contract: FeedContract) -> DataFrame:
    """How many rows of each delivery repeat content that was already delivered."""
    repeated = F.col("copies") - F.when(F.col("_before") == 0, 1).otherwise(0)
    return (
        _numbered_copies(lines, contract)
        .withColumn("replayed_rows", repeated)
        .where(F.col("replayed_rows") > 0)
        .select(*contract.line_key, "_row_hash", "_delivery_month", "replayed_rows")
    )


def version_rank(earliest: DataFrame, contract: FeedContract) -> DataFrame:
    """Number the versions of each key from the latest on.

    Versions are numbered inside slices of one delivery and hash prefix, and the sizes of the newer
    slices are added, so a key with very many versions is ranked by many tasks.
    """
    key = F.struct(*contract.line_key)
    prefix = F.coalesce(F.substring("_row_hash", 1, HASH_DIGITS), F.lit(""))
    sliced = earliest.withColumn("_key", key).withColumn("_prefix", prefix)
    slice_columns = ["_prefix", "_key", "_delivery_month"]
    newer = (
        Window.partitionBy("_key")
        .orderBy(F.col("_delivery_month").desc_nulls_last(), F.col("_prefix").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = (
        sliced.groupBy(*slice_columns)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*slice_columns, F.coalesce(F.sum("_size").over(newer), F.lit(0)).alias("_newer"))
    )
    inside = Window.partitionBy(*slice_columns).orderBy(F.col("_row_hash").desc_nulls_last())
    return (
        sliced.withColumn("_inside", F.row_number().over(inside))
        .join(sizes, slice_columns)
        .select(*earliest.columns, (F.col("_newer") + F.col("_inside")).alias("version_rank"))
    )


def silver_line(
    lines: DataFrame, excepted: DataFrame | None, contract: FeedContract, ingested_at: Column
) -> DataFrame:
    """Full rows of the latest versions, current unless superseded. Without ``excepted`` no line is an exception.

    ``excepted`` is best read from a written table: Spark broadcasts it by its real size below its own
    limit, and otherwise shuffles both sides on the line id, which spreads evenly whatever the keys are.
    """
    if excepted is None:
        kept, is_superseded = lines, F.lit(False)
    else:
        marks = excepted.select(LINE_ID, "_exception")
        is_superseded = F.coalesce(F.col("_exception") == SUPERSEDED, F.lit(False))
        kept = lines.join(marks, LINE_ID, "left").where(
            F.col("_exception").isNull() | (F.col("_exception") != DROPPED)
        )
    return (
        grade(kept, contract)
        .withColumns(
            {
                "_ingested_at": ingested_at,
                "is_current": ~is_superseded,
                "is_superseded": is_superseded,
            }
        )
        .select(*contract.published_columns)
    )
