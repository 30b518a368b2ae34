"""The shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from feedgate.sinks.tables import side_by_side

# Lines that one shuffle partition is planned for; adaptive execution merges partitions that turn out small.
LINES_PER_PARTITION = 250_000
# Tables of so many columns take the compression of their workspace. Slim ones keep the session's: Spark judges by the
# size of the files whether to broadcast them.
WIDE_COLUMNS = 20
PLANNED_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def fit_partitions(spark: SparkSession, lines: int) -> None:
    """Let shuffles start with partitions in proportion to the feed, so that a task holds as much of a large feed as of a small one.

    Raises the session's setting and never lowers it. Adaptive execution merges partitions towards its advisory
    size, so a generous number costs little.
    """
    planned = spark.conf.get(PLANNED_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    needed = -(-lines // LINES_PER_PARTITION)
    if needed > int(planned):
        spark.conf.set(PLANNED_PARTITIONS, str(needed))


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver falls back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix="feedgate-")


class Workspace:
    """A folder of its own for one run; intermediate tables survive the loss of executors."""

    def __init__(self, spark: SparkSession, name: str, root: str | None = None, compression: str | None = None):
        self.spark = spark
        self.options = {"compression": compression} if compression else {}
        self.root = root or f"{shared_folder(spark).rstrip('/')}/feedgate-{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def keep(self, name: str, df: DataFrame, partition: str | None = None) -> DataFrame:
        """Write a table and continue from it: a columnar checkpoint with pruned reads."""
        options = self.options if len(df.columns) >= WIDE_COLUMNS else {}
        with side_by_side(self.spark):
            df.write.mode("overwrite").options(**options).parquet(self.path(name), partitionBy=partition)
        return self.spark.read.schema(df.schema).parquet(self.path(name)).select(df.columns)

    def close(self) -> None:
        """Delete the folder; tables kept in it must not be read any more."""
        self._files().delete(self._folder(), True)

    def only(self, *names: str) -> None:
        """Delete all tables but the named ones."""
        files = self._files()
        if files.exists(self._folder()):
            for found in files.listStatus(self._folder()):
                if found.getPath().getName() not in names:
                    files.delete(found.getPath(), True)

    def _folder(self):
        return self.spark._jvm.org.apache.hadoop.fs.Path(self.root)

    def _files(self):
        return self._folder().getFileSystem(self.spark._jsc.hadoopConfiguration())
