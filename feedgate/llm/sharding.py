"""Operator 8: shards and slots from a Feistel permutation of global row numbers.

Rows are numbered in one reproducible order, by ``doc_id``, text size, checksum and hash. A keyed Feistel
network permutes the smallest power of four that holds all rows; an image outside the table is permuted
again until it falls inside (cycle walking), which keeps the map one to one. Image p goes to shard
``p % shards``, slot ``p // shards``, so shard sizes differ by at most one, slots have no gaps, and both can be
computed from the row number, the row count and the seed alone.

Defined results: null text counts as empty. Null ids come first. Rows equal in id and text are
interchangeable; each gets its own place. ``row_number``, ``shard`` and ``slot`` columns of the input are
replaced; other columns stay. An empty table gives an empty result.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedgate.llm.words import mix
from feedgate.plans.workspace import Workspace

SHARDS = 24
SEED = 20_240_607
ROUNDS = 6


def _feistel(values: np.ndarray, half: int, seed: int) -> np.ndarray:
    mask = np.uint64((1 << half) - 1)
    left, right = values >> np.uint64(half), values & mask
    for turn in range(ROUNDS):
        key = mix(np.full(1, seed * ROUNDS + turn, np.uint64))
        left, right = right, left ^ (mix(right ^ key) & mask)
    return left << np.uint64(half) | right


def permuted(rows: np.ndarray, total: int, seed: int = SEED) -> np.ndarray:
    """The place of each row number below ``total``: a permutation of ``range(total)``."""
    half = max(1, (int(total - 1).bit_length() + 1) // 2)
    out = _feistel(rows.astype(np.uint64), half, seed)
    while (outside := np.flatnonzero(out >= np.uint64(total))).size:
        out[outside] = _feistel(out[outside], half, seed)
    return out.astype(np.int64)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def numbered(docs: DataFrame, columns: list[str]) -> tuple[DataFrame, int]:
    """``row`` (the given columns) and its global ``number``, and the row count.

    Rows are range-partitioned and sorted once and written; the driver adds up one count per partition.
    The last sort key only tells rows with equal id and text apart, so many repeats still spread out.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(
        F.struct(*[_quoted(c) for c in columns]).alias("row"),
        F.col("doc_id").alias("k1"),
        F.octet_length(text).alias("k2"),
        F.crc32(text.cast("binary")).alias("k3"),
        F.xxhash64(text).alias("k4"),
        F.monotonically_increasing_id().alias("k5"),
    )
    keys = ["k1", "k2", "k3", "k4", "k5"]
    ordered = (
        keyed.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .select("row", F.monotonically_increasing_id().alias("at"))
    )
    ordered = Workspace(spark, "shard").keep("ordered", ordered)
    part = F.shiftrightunsigned("at", 33)
    counts = sorted(ordered.groupBy(part.alias("part")).count().collect())
    starts = [0, *accumulate(n for _, n in counts)]
    begins = spark.createDataFrame(
        [(int(p), s) for (p, _), s in zip(counts, starts, strict=False)], "part long, start long"
    )
    local = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition, so the broadcast is bounded by the number of shuffle partitions.
    placed = ordered.withColumn("part", part).join(F.broadcast(begins), "part")
    return placed.select("row", (F.col("start") + local).alias("number")), starts[-1]


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, columns: list[str] | None = None) -> DataFrame:
    """All (or the given) columns of ``docs(doc_id, text)`` with ``row_number``, ``shard`` and ``slot``."""
    own = [c for c in (columns or docs.columns) if c.lower() not in ("row_number", "shard", "slot")]
    rows, total = numbered(docs, own)

    @F.pandas_udf("long")
    def place(number: pd.Series) -> pd.Series:
        return pd.Series(permuted(number.to_numpy(), total, seed))

    placed = rows.withColumn("place", place("number"))
    return placed.select(
        *[F.col(f"row.{_quoted(c)}") for c in own],
        F.col("number").alias("row_number"),
        (F.col("place") % shards).cast("int").alias("shard"),
        F.expr(f"place div {shards}").alias("slot"),
    )
