"""Operator 2: mixing sources to target weights by Poisson replication.

Each source gets a repetition rate: its target share of the mixture's size over the size it has. A document's
number of copies is the inverse of the Poisson distribution with that mean at a uniform number hashed from
the seed and the ``doc_id``; copies are then spread over all partitions by a second hash and sorted by it.

Defined results: a null source is a source of its own; null text has size 0; a source without any text gets
rate 1. Rows that repeat a ``doc_id`` get the same number of copies. A source that ``weights`` does not name gets
weight 0. ``copies``, ``copy`` and ``shuffle_key`` columns of the input are replaced. An empty table gives an empty
result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedgate.plans.workspace import Workspace

SEED = 11
# Without explicit weights, a source weighs its size to this power: large sources count less than in proportion.
POWER = 0.5


def hashed(*parts) -> Column:
    """52 bits of the md5 of the parts, as a long."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def poisson_table(rate: float) -> tuple[int, np.ndarray]:
    """The cumulative Poisson probabilities of ``first``, ``first + 1``, ... around the mean.

    Twelve deviations and thirty to each side leave out less than a double tells from 0 or 1, so the table grows with the
    root of the rate. Probabilities are carried as logarithms, so none of them underflows.
    """
    if not rate > 0:
        return 0, np.ones(1)
    reach = 12 * math.sqrt(rate) + 30
    first = max(0, math.floor(rate - reach))
    steps = np.log(rate / np.arange(first + 1, math.ceil(rate + reach) + 1))
    least = first * math.log(rate) - rate - math.lgamma(first + 1)
    return first, np.cumsum(np.exp(np.cumsum(np.concatenate([[least], steps]))))


TABLE = T.StructType([T.StructField("first", T.LongType()), T.StructField("cumulative", T.ArrayType(T.DoubleType()))])


@F.pandas_udf(TABLE)
def poisson_tables(rate: pd.Series) -> pd.DataFrame:
    """One table for each source."""
    return pd.DataFrame([poisson_table(r) for r in rate], columns=["first", "cumulative"])


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None) -> DataFrame:
    """``source, rate``: how often each source is repeated so that the mixture keeps the size of the table."""
    sizes = docs.groupBy("source").agg(F.sum(F.col("size").cast("double")).alias("held"))
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow("held", F.lit(POWER)))
    else:
        named = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.lit(None)
        found = named[F.col("source")] if weights else F.lit(None)
        weighted = sizes.withColumn("weight", F.coalesce(found.cast("double"), F.lit(0.0)))
    total = weighted.agg(F.sum("held").alias("all_held"), F.sum("weight").alias("all_weight"))
    rate = F.expr("case when held > 0 and all_weight > 0 then weight / all_weight * all_held / held else 1D end")
    # One row of totals.
    return weighted.join(F.broadcast(total)).select("source", rate.alias("rate"))


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """Every copy of every document: the columns of ``docs`` with ``copies``, ``copy`` and ``shuffle_key``.

    ``docs`` has ``doc_id``, ``source`` and either ``size`` or ``text``, whose length is then the size. The table of
    rates is written first, so Spark knows its size and broadcasts it only if small; beyond that the join
    can split a hot source.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c.lower() not in ("copies", "copy", "shuffle_key")]
    quoted = ["`" + c.replace("`", "``") + "`" for c in own]
    docs = docs.select(*quoted)
    by_name = {c.lower() for c in own}
    size = F.col("size") if "size" in by_name else F.coalesce(F.length(F.col("text").cast("string")), F.lit(0))
    table = rates(docs.select(F.col("source"), size.alias("size")), weights)
    table = table.select(F.col("source").alias("of"), poisson_tables("rate").alias("table"))
    table = Workspace(spark, "mixing").keep("rates", table)
    rows = docs.select(F.struct(*quoted).alias("row"), F.col("doc_id").alias("id"), F.col("source").alias("from"))
    uniform = hashed(F.lit(seed), F.col("id")) / F.lit(float(1 << 52))
    counted = (
        rows.join(table, F.col("from").eqNullSafe(F.col("of")))
        .withColumn("u", uniform)
        .select("row", "id", F.expr("int(table.first + size(filter(table.cumulative, x -> x <= u)))").alias("copies"))
        .where("copies > 0")
    )
    every = counted.select("row", "id", "copies", F.explode(F.expr("sequence(1, copies)")).alias("copy"))
    every = every.withColumn("shuffle_key", hashed(F.lit(seed), F.col("id"), F.col("copy")))
    spread = every.repartition("shuffle_key", "id", "copy").sortWithinPartitions("shuffle_key", "id", "copy")
    return spread.select(*[F.col(f"row.{q}") for q in quoted], "copies", "copy", "shuffle_key")
