"""Operator 3: token counts as delta-maintained rollups.

A batch of changes (insert, delete, revise) becomes signed rows of a ledger: an insert adds a document's
tokens, a delete takes back what the ledger holds, a revision takes that back and adds the new count, also under
another tokenizer version. Rollups are sums of the signed rows by source, language and version, stored per
batch; totals add up the committed batches and never read a document again.

A batch is written to a folder of its own name, ledger first and rollup last, and counts as committed once
Spark's success marker of the rollup is there. Committing it again does nothing; a batch that was cut off is
written anew in full. Batches are committed one after another.

The ledger lies in BUCKETS folders by hash of the document, and a commit reads the buckets of its own documents only.
Compaction folds all committed batches into one table of what is held and one of totals; later commits and totals
read these and the batches after them, so their cost does not grow with history. It changes no result, may run between any two
commits, and counts once its list of batches, written last, is complete; one that was cut off is written anew.

Defined results: null text has 0 tokens. Null source and language are groups of their own. In one batch a
``doc_id`` counts once: repeated rows with the same change and text are one change, of different ones delete
comes before revise before insert, then the smallest text. Inserting a document the ledger holds already and
deleting or revising one it does not hold changes nothing. Rows without ``doc_id`` or with an unknown change are ignored.
Extra columns are not read. An empty batch commits an empty folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedgate.llm.batches import bounded_batches
from feedgate.llm.bpe import TOKENIZER, encoder

KEYS = ("source", "lang", "tokenizer")
ENTRY = "doc_id long, source string, lang string, tokenizer string, tokens long, sign int, bucket int"
LEDGER = f"{ENTRY}, batch string"
ROLLUP = "source string, lang string, tokenizer string, documents long, tokens long"
CHANGES = "doc_id long, order int, new_source string, new_lang string, new_tokens long, bucket int"

# Part of the layout on disk: the same for all batches of a store.
BUCKETS = 64


def space_tokens(text: Column) -> Column:
    """Tokens between white space: the plain tokenizer version ``space-1``."""
    words = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.octet_length(F.regexp_replace(words, r"[\x20\x09-\x0D]+", "")).cast("long")


def bpe_tokens(path: str = TOKENIZER):
    """A column function: tokens under a public byte-pair vocabulary, in Arrow batches."""

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(path).encode_ordinary
        for texts in parts:
            yield pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return count


def bucket(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(BUCKETS)).cast("int")


class Rollups:
    """The folder of committed batches and of their compactions."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, batch: str, table: str) -> str:
        return f"{self.root}/{table}/batch={batch}"

    def _complete(self, pattern: str) -> list[str]:
        """Names of the folders that hold Spark's success marker at ``pattern``, by one look at the file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{pattern}/_SUCCESS")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        depth = len(pattern.split("/")) - pattern.split("/").index("*")
        names = []
        for status in found or []:
            at = status.getPath()
            for _ in range(depth):
                at = at.getParent()
            names.append(at.getName())
        return sorted(names)

    def _compaction(self) -> str | None:
        """The latest complete compaction."""
        numbers = self._complete("compacted/*/batches")
        return f"{self.root}/compacted/{max(numbers, key=int)}" if numbers else None

    def _folded(self, compaction: str | None) -> set[str]:
        """Batches within a compaction: one short name for each commit."""
        if compaction is None:
            return set()
        return {r.batch for r in self.spark.read.schema("batch string").parquet(f"{compaction}/batches").collect()}

    def batches(self) -> list[str]:
        """The committed batches."""
        return [n.removeprefix("batch=") for n in self._complete("rollup/*")]

    def committed(self, batch: str) -> bool:
        return batch in self.batches()

    def _read(self, table: str, schema: str, batches: list[str]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        paths = [self._path(b, table) for b in batches]
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{table}").parquet(*paths)

    def _entries(self) -> DataFrame:
        """What the last compaction holds, and the ledgers of the batches after it."""
        compaction = self._compaction()
        folded = self._folded(compaction)
        entries = self._read("ledger", LEDGER, [b for b in self.batches() if b not in folded]).drop("batch")
        if compaction is not None:
            entries = entries.unionByName(self.spark.read.schema(ENTRY).parquet(f"{compaction}/held"))
        return entries

    @staticmethod
    def _summed(entries: DataFrame) -> DataFrame:
        grouped = entries.groupBy("doc_id", "bucket", *KEYS, "tokens").agg(F.sum("sign").cast("int").alias("sign"))
        return grouped.where("sign > 0")

    def held(self) -> DataFrame:
        """What the ledger holds per document: the last row of every document that is not deleted."""
        return self._summed(self._entries()).drop("sign", "bucket")

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer version; groups that fell to zero are left out."""
        compaction = self._compaction()
        folded = self._folded(compaction)
        sums = self._read("rollup", ROLLUP, [b for b in self.batches() if b not in folded]).select(*KEYS, "documents", "tokens")
        if compaction is not None:
            sums = sums.unionByName(self.spark.read.schema(ROLLUP).parquet(f"{compaction}/totals"))
        summed = sums.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return summed.where("documents <> 0 or tokens <> 0")

    def compact(self) -> bool:
        """Fold all committed batches into one state; False if there is nothing new to fold."""
        compaction, batches = self._compaction(), self.batches()
        if set(batches) == self._folded(compaction):
            return False
        number = int(compaction.rsplit("/", 1)[1]) + 1 if compaction else 0
        target = f"{self.root}/compacted/{number}"
        self._by_bucket(self._summed(self._entries()), f"{target}/held")
        self.totals().write.mode("overwrite").parquet(f"{target}/totals")
        names = self.spark.createDataFrame([(b,) for b in batches], "batch string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{target}/batches")
        return True

    @staticmethod
    def _by_bucket(rows: DataFrame, path: str) -> None:
        """Rebalanced, so that a task does not write a file for each bucket; large buckets are split."""
        rows.hint("rebalance", "bucket").write.mode("overwrite").parquet(path, partitionBy="bucket")

    def commit(self, batch: str, changes: DataFrame, tokenizer: str, tokens: Column) -> bool:
        """Commit ``changes(change, doc_id, text, source, lang)``; False if this batch was committed before.

        Texts are counted once, before anything is shuffled; only ids, groups and counts travel. They are written, so that
        the buckets to read are known and no text is counted again after a failure.
        """
        if self.committed(batch):
            return False
        bounded_batches(self.spark)
        order = F.expr("case change when 'delete' then 0 when 'revise' then 1 when 'insert' then 2 end")
        text = F.col("text").cast("string")
        counted = changes.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            order.alias("order"),
            F.col("source").cast("string").alias("new_source"),
            F.col("lang").cast("string").alias("new_lang"),
            F.when(order > 0, tokens).otherwise(F.lit(0)).cast("long").alias("new_tokens"),
            F.xxhash64(text).alias("text_hash"),
        ).where("doc_id is not null and order is not null")
        first = F.min_by(
            F.struct("order", "new_source", "new_lang", "new_tokens"), F.struct("order", "text_hash", "new_source", "new_lang")
        )
        slim = counted.groupBy("doc_id").agg(first.alias("x")).select("doc_id", "x.*").withColumn("bucket", bucket(F.col("doc_id")))
        slim.write.mode("overwrite").parquet(self._path(batch, "changes"))
        one = self.spark.read.schema(CHANGES).parquet(self._path(batch, "changes"))
        # At most BUCKETS numbers.
        touched = [r.bucket for r in one.select("bucket").distinct().collect()]
        mine = self._entries().where(F.col("bucket").isin(touched)).join(one.select("doc_id"), "doc_id", "left_semi")
        both = one.join(self._summed(mine).drop("sign", "bucket"), "doc_id", "left")
        both = both.withColumn("is_held", F.col("tokenizer").isNotNull())
        # One pass over the changes: both kinds of rows come from the same joined row.
        signed = both.select(
            "bucket",
            F.explode(
                F.array(
                    F.when(
                        F.expr("order < 2 and is_held"),
                        F.struct("doc_id", *KEYS, "tokens", F.lit(-1).alias("sign")),
                    ),
                    F.when(
                        F.expr("(order = 2 and not is_held) or (order = 1 and is_held)"),
                        F.struct(
                            "doc_id",
                            F.col("new_source").alias("source"),
                            F.col("new_lang").alias("lang"),
                            F.lit(tokenizer).alias("tokenizer"),
                            F.col("new_tokens").alias("tokens"),
                            F.lit(1).alias("sign"),
                        ),
                    ),
                )
            ).alias("row"),
        ).where("row is not null").select("row.*", "bucket")
        self._by_bucket(signed, self._path(batch, "ledger"))
        rows = self._read("ledger", LEDGER, [batch])
        rollup = rows.groupBy(*KEYS).agg(
            F.sum(F.col("sign").cast("long")).alias("documents"), F.sum(F.col("sign") * F.col("tokens")).alias("tokens")
        )
        rollup.write.mode("overwrite").parquet(self._path(batch, "rollup"))
        return True
