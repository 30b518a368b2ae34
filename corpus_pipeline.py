"""The corpus pipeline: from raw documents to a cleaned, mixed and sharded training corpus.

Every stage takes all rows its predecessor kept and returns whole rows. Rows are judged one by one, also where a
``doc_id`` repeats. Documents without ``doc_id`` are not dropped as near copies; the other stages judge them too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedgate.llm import decontaminate, mixing, near_dedup, sharding, toxicity
from feedgate.plans.workspace import Workspace

TOXIC_FROM = 0.5
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose most toxic passage is no more than chance."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return near_dedup.without_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy, edited or not, of a benchmark item."""
    # The text alone decides; the id only spreads out rows of one text.
    digest = F.md5(docs["text"].cast("string").cast("binary"))
    rows = docs.select(F.struct(F.col("doc_id").alias("id"), digest.alias("digest")).alias("doc_id"), "text")
    found = decontaminate.contaminated(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = Workspace(spark, "pipeline").keep("contaminated", found.select("doc_id.id", "doc_id.digest").distinct())
    same = docs["doc_id"].eqNullSafe(found["id"]) & (digest == found["digest"])
    return docs.join(found, same, "left_anti").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight asks for."""
    return mixing.mix_sources(docs).select(docs.columns)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and slot."""
    return sharding.shard(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix_sources", mix_sources),
    ("shard", assign_shards),
]

# Learned scores, signatures and alignments cannot be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = work.keep(f"{number}-{name}", stage(spark, docs, sf_dir))
    return docs
