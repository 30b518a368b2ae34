"""Bit filters: which rows of a large table may have a partner in another one, found without shuffling the large one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a filter, which bound what is broadcast: at most 1,048,576 words of 64 bits. Keys share bits when there are many
# more of them; more rows then count as candidates, and no partner is ever missed.
FILTER_BITS = 1 << 26
WORD_BITS = 64

# Tables of fewer rows need no filter: Spark broadcasts them.
FILTER_FROM = 1_000_000


def _hashed(key: Sequence[str]) -> Column:
    return F.xxhash64(*key)


def _filter(hashes: DataFrame) -> DataFrame:
    slot = F.pmod("_hash", F.lit(FILTER_BITS))
    bit = F.expr(f"shiftleft(1L, cast(_slot % {WORD_BITS} as int))")
    words = hashes.select(slot.alias("_slot")).select(F.floor(F.col("_slot") / WORD_BITS).alias("_word"), bit.alias("_bit"))
    return words.groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))


def bit_filter(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The filter of all keys of ``rows``; NULL counts as a value. Best written before it is used."""
    return _filter(rows.select(_hashed(key).alias("_hash")))


def recurring_filter(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The filter of the keys that several rows have. Only hashes are counted, and before they are shuffled."""
    counted = rows.select(_hashed(key).alias("_hash")).groupBy("_hash").agg(F.count(F.lit(1)).alias("_rows"))
    return _filter(counted.where("_rows > 1"))


def _tested(rows: DataFrame, words: DataFrame, key: Sequence[str]) -> DataFrame:
    slot = F.pmod(_hashed(key), F.lit(FILTER_BITS))
    placed = rows.withColumn("_slot", slot).withColumn("_word", F.floor(F.col("_slot") / WORD_BITS))
    bit = F.getbit("_bits", (F.col("_slot") % WORD_BITS).cast("int"))
    return placed.join(F.broadcast(words), "_word", "left").withColumn("_hit", F.coalesce(bit, F.lit(0)) == 1)


def candidates(rows: DataFrame, words: DataFrame | None, key: Sequence[str]) -> DataFrame:
    """Rows whose key may be in the filter: all that are, and some that are not. All rows of a key are kept or none."""
    return rows if words is None else _tested(rows, words, key).where("_hit").select(*rows.columns)


def others(rows: DataFrame, words: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows that are no candidates, where they are read: their key is not in the filter."""
    return _tested(rows, words, key).where("not _hit").select(*rows.columns)
