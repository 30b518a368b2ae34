"""Read monthly deliveries, each in its own physical format and schema."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from py4j.protocol import Py4JJavaError
from pyarrow import fs
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedgate.functions.columns import DELIVERY_NAME
from feedgate.operators.staging import union_deliveries

# What Spark says of part files whose types cannot be merged.
MIXED_PARTS = "CANNOT_MERGE_SCHEMAS"


@dataclass(frozen=True)
class Delivery:
    """One delivery: a file, or a directory of part files, named claims_YYYYMM.<format>.

    Set ``multiline`` for a delimited one with line breaks inside quoted fields: its files are then not split.
    """

    path: str
    multiline: bool = False

    @property
    def name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]

    @property
    def month(self) -> str:
        found = re.search(DELIVERY_NAME, self.name)
        return "-".join(found.groups()) if found else "unknown"

    @property
    def is_delimited(self) -> bool:
        return self.name.lower().endswith(".csv")

    @property
    def file_format(self) -> str:
        return "csv" if self.is_delimited else "parquet"


def manifest(paths: Sequence[str], multiline: bool = False) -> list[Delivery]:
    """The deliveries of a feed; two of one month are refused."""
    found = [Delivery(p, multiline) for p in paths]
    months = [d.month for d in found]
    repeated = sorted({m for m in months if months.count(m) > 1})
    if repeated:
        raise ValueError(f"several deliveries of one month: {', '.join(repeated)}")
    return found


def expected_deliveries(spark: SparkSession, deliveries: Sequence[Delivery]) -> DataFrame:
    """The calendar of deliveries that must exist."""
    months = sorted({d.month for d in deliveries})
    return spark.createDataFrame([(m,) for m in months], "delivery_month string")


# The text of a row with more or fewer fields than its header, where such rows are kept.
REJECTED = "_rejected"


def delimited_options(sep: str = "|", multiline: bool = False, rejects: bool = False) -> dict[str, str]:
    """How delimited text is read, by the readers and by the catalog alike."""
    options = {
        "sep": sep,
        "header": "true",
        "inferSchema": "false",
        "quote": '"',
        "escape": '"',
        "enforceSchema": "false",
        "columnPruning": "false",
        "mode": "PERMISSIVE" if rejects else "FAILFAST",
        "multiLine": str(multiline).lower(),
    }
    return options | ({"columnNameOfCorruptRecord": REJECTED} if rejects else {})


def read_delimited(spark: SparkSession, path: str, sep: str = "|", multiline: bool = False) -> DataFrame:
    """Header line, every column text, doubled quotes inside quoted fields.

    Nothing is shifted, cut or padded: a part file whose header differs from the first one fails the read, and
    so does a row with more or fewer fields than the header. Whole rows are parsed for that, whatever is selected.
    """
    return spark.read.options(**delimited_options(sep, multiline)).csv(path)


def read_delimited_rows(spark: SparkSession, path: str, sep: str = "|", multiline: bool = False) -> DataFrame:
    """``read_delimited`` that keeps rows with more or fewer fields: their text is in ``_rejected``, NULL for others.

    Spark does not read the rejected text alone from files; write the rows first.
    """
    header = read_delimited(spark, path, sep, multiline).schema
    fields = T.StructType([*header.fields, T.StructField(REJECTED, T.StringType())])
    return spark.read.options(**delimited_options(sep, multiline, rejects=True)).schema(fields).csv(path)


def _layout(path: str) -> str | None:
    """The columns and types in the footer of a part file; None where it cannot be read from a task."""
    uri = re.sub("^file:/+", "file:///", path)
    try:
        store, name = fs.FileSystem.from_uri(uri)
        with store.open_input_file(name) as file:
            return pq.read_schema(file).remove_metadata().to_string(show_field_metadata=False)
    except (pa.ArrowException, OSError, ValueError):
        return None


def _layouts(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for part in parts:
        yield part.assign(layout=[_layout(path) for path in part["path"]])


def schema_groups(spark: SparkSession, path: str) -> list[tuple[T.StructType, list[str]]]:
    """The part files of a Parquet delivery by schema, in the order of their names.

    Footers are read in tasks and grouped by what they say; the driver reads one of each group. Only files that
    tasks cannot open by themselves are read by the driver one by one.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    read = listed.mapInPandas(_layouts, "path string, layout string")
    found = read.groupBy("layout").agg(F.sort_array(F.collect_list("path")).alias("files")).collect()
    groups: dict[str, list[str]] = {}
    for row in found:
        for files in [row.files] if row.layout is not None else [[f] for f in row.files]:
            groups.setdefault(spark.read.parquet(files[0]).schema.json(), []).extend(files)
    ordered = sorted(groups.items(), key=lambda group: min(group[1]))
    return [(T.StructType.fromJson(json.loads(schema)), sorted(files)) for schema, files in ordered]


def merged_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """One schema with the columns of all part files; None where their types cannot be merged."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    except (PySparkException, Py4JJavaError) as error:
        if MIXED_PARTS not in str(error):
            raise
        return None


def read_parquet_delivery(spark: SparkSession, path: str) -> DataFrame:
    """Whatever the vendor wrote, with the columns of all part files.

    Parts whose types differ are read one schema at a time and put together by name.
    """
    schema = merged_schema(spark, path)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return union_deliveries([spark.read.schema(s).parquet(*files) for s, files in schema_groups(spark, path)])


def read_physical(spark: SparkSession, delivery: Delivery) -> DataFrame:
    if delivery.is_delimited:
        return read_delimited(spark, delivery.path, multiline=delivery.multiline)
    return read_parquet_delivery(spark, delivery.path)


def with_lineage(df: DataFrame, delivery: Delivery) -> DataFrame:
    """Constant lineage columns, so a filter on the delivery drops whole branches of the union."""
    return df.withColumns(
        {"_delivery_month": F.lit(delivery.month), "_source_file": F.lit(delivery.name)}
    )


def read_delivery(spark: SparkSession, delivery: Delivery) -> DataFrame:
    return with_lineage(read_physical(spark, delivery), delivery)


def open_feed(spark: SparkSession, deliveries: Sequence[Delivery]) -> dict[Delivery, DataFrame | None]:
    """The lazy frame of every delivery; None where no column can be read from it. A refused access is raised."""
    frames: dict[Delivery, DataFrame | None] = {}
    for delivery in deliveries:
        try:
            frame = read_physical(spark, delivery)
        except (PySparkException, Py4JJavaError) as error:  # a broken footer surfaces as the latter
            if "AccessControlException" in str(error):
                raise
            frame = None
        frames[delivery] = with_lineage(frame, delivery) if frame is not None and frame.columns else None
    return frames


def read_feed(spark: SparkSession, deliveries: Sequence[Delivery]) -> DataFrame:
    """All deliveries as one staged table; an unreadable one fails the read."""
    return union_deliveries([read_delivery(spark, d) for d in deliveries])


def read_dimension(spark: SparkSession, path: str) -> DataFrame:
    """The token graph as it is."""
    return spark.read.parquet(path)
