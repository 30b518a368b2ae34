"""Write tables as Parquet, and switch all tables of a build at once."""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

PARTITION = "_delivery_month"

# Deliveries a task writes as they come; a task that meets more of them sorts the rest of its lines, which costs less time
# than filling the columns of many files in turn.
OPEN_DELIVERIES = 1
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

# Compressed shuffle data of a task that sorts lines by delivery which are much wider than what it read, so that it does not
# spill them. More tasks write more files, so a table of lines as wide as those shuffled keeps the session's setting.
SORTED_BYTES = 16 << 20
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@contextmanager
def side_by_side(spark: SparkSession) -> Iterator[None]:
    """Write partitioned tables without sorting the wide rows of a task that holds one partition."""
    with _set(spark, WRITERS, str(max(int(spark.conf.get(WRITERS)), OPEN_DELIVERIES))):
        yield


@contextmanager
def small_tasks(spark: SparkSession) -> Iterator[None]:
    """Let adaptive execution merge shuffle partitions only as far as a task can sort its wide rows in memory."""
    with _set(spark, ADVISORY, str(SORTED_BYTES)):
        yield


@contextmanager
def _set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_partitioned(df: DataFrame, path: str, partition: str = PARTITION) -> None:
    """Replace the table directory, one partition per delivery.

    The rebalance hint gathers each delivery into files near the advisory partition size; adaptive
    execution splits a delivery that is larger than that, so a heavy month is written by many tasks.
    """
    with side_by_side(df.sparkSession):
        (
            df.hint("rebalance", partition)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("compression", "zstd")
            .partitionBy(partition)
            .parquet(path)
        )


def write_audit(df: DataFrame, path: str) -> None:
    """Replace a small unpartitioned table; audit tables hold one row per file or delivery."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put a finished table in the place of the previous one, by renames inside one file system.

    The previous table is kept next to the staged one until that folder is deleted, and comes back if the
    second rename fails.
    """
    new, old, aside = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, path, f"{staged}-replaced"))
    files = new.getFileSystem(spark._jsc.hadoopConfiguration())
    had_table = files.exists(old)
    if had_table and not files.rename(old, aside):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(new, old):
        if had_table:
            files.rename(aside, old)
        raise OSError(f"cannot publish {path}")


# A folder of generations: each holds all tables of one build, and one small file names the current one.
CURRENT = "_current.json"
GENERATION = "generation-"


def _hadoop(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    found, files = _hadoop(spark, path)
    return files.exists(found)


def current_generation(spark: SparkSession, out: str) -> str | None:
    """The folder of the build that readers should see; none before the first one."""
    pointer, files = _hadoop(spark, f"{out}/{CURRENT}")
    if not files.exists(pointer):
        return None
    return f"{out}/{json.loads(_read_text(files, pointer))['generation']}"


def _read_text(files, path) -> str:
    """A file of a few bytes, read on the driver."""
    stream = files.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def switch(spark: SparkSession, out: str, staged: str, name: str) -> str:
    """Move a folder of finished tables into place as a generation, and make it the current one.

    Until the pointer file is replaced, by one renaming that overwrites, readers see all old tables; from then on
    all new ones. A failure before leaves an unnamed folder behind, which the next clean-up removes.
    """
    target = f"{out}/{GENERATION}{name}"
    new, files = _hadoop(spark, target)
    if not files.rename(_hadoop(spark, staged)[0], new):
        raise OSError(f"cannot move {staged} to {target}")
    point_to(spark, out, f"{GENERATION}{name}")
    return target


def point_to(spark: SparkSession, out: str, generation: str) -> None:
    """Replace the pointer file; also how to go back to an older generation."""
    pointer, files = _hadoop(spark, f"{out}/{CURRENT}")
    written, _ = _hadoop(spark, f"{out}/_{generation}.json")
    stream = files.create(written, True)
    try:
        stream.write(bytearray(json.dumps({"generation": generation}).encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(written, pointer, options)


def drop_generations(spark: SparkSession, out: str, keep: int) -> None:
    """Delete all generations but the current one and the ``keep - 1`` youngest others, which readers may still hold."""
    folder, files = _hadoop(spark, out)
    current = (current_generation(spark, out) or "").rsplit("/", 1)[-1]
    found = [f for f in files.listStatus(folder) if f.getPath().getName().startswith(GENERATION)]
    others = sorted((f for f in found if f.getPath().getName() != current), key=lambda f: f.getPath().getName())
    for old in others[: max(0, len(others) - keep + 1)]:
        files.delete(old.getPath(), True)
