"""Judge deliveries one by one on arrival, so that a broken one stops itself and not the feed."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedgate.contract import FeedContract
from feedgate.operators.staging import union_deliveries
from feedgate.sources.deliveries import REJECTED, Delivery, read_delimited_rows, read_parquet_delivery, with_lineage

Keep = Callable[..., DataFrame]
REJECTED_ROWS = "_delivery_month string, _source_file string, file_path string, record string"
ISSUES = "_delivery_month string, reason string"


@dataclass(frozen=True)
class Arrivals:
    """What was found: a frame per delivery, None where nothing can be read; rows that do not fit; reasons against deliveries."""

    frames: dict[Delivery, DataFrame | None]
    rejected: DataFrame
    issues: DataFrame
    refused: frozenset[Delivery]

    def staged(self, contract: FeedContract) -> DataFrame:
        """All deliveries that can be measured, as one table; without any, an empty one of the contracted columns."""
        read = [frame for d, frame in self.frames.items() if frame is not None and d not in self.refused]
        if read:
            return union_deliveries(read)
        names = [*contract.columns, "_delivery_month", "_source_file"]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        return self.issues.sparkSession.createDataFrame([], schema)


def _delimited(spark: SparkSession, delivery: Delivery, keep: Keep) -> tuple[DataFrame, DataFrame]:
    """Rows that fit their header and rows that do not, parsed once and written."""
    rows = read_delimited_rows(spark, delivery.path, multiline=delivery.multiline)
    if rows.columns == [REJECTED]:
        raise PySparkException(f"no header in {delivery.path}")
    parsed = keep(f"parsed_{delivery.month}", rows.withColumn("_file_path", F.col("_metadata.file_path")))
    rejected = parsed.where(F.col(REJECTED).isNotNull()).select(
        F.lit(delivery.month).alias("_delivery_month"),
        F.lit(delivery.name).alias("_source_file"),
        F.col("_file_path").alias("file_path"),
        F.col(REJECTED).alias("record"),
    )
    return parsed.where(F.col(REJECTED).isNull()).drop(REJECTED, "_file_path"), rejected


def receive(spark: SparkSession, deliveries: Sequence[Delivery], contract: FeedContract, keep: Keep) -> Arrivals:
    """Open every delivery and note what is wrong with it.

    UNREADABLE_FILE: no file, no header, a broken footer, or part files whose headers differ. MISSING_REQUIRED_COLUMNS: not
    all columns that the contract requires. REJECTED_ROWS: rows with more or fewer fields than the header; they are
    listed. Delimited deliveries are parsed once and written by ``keep``; of Parquet the footers are read. A refused
    access is raised.
    """
    frames: dict[Delivery, DataFrame | None] = {}
    reasons: list[tuple[str, str]] = []
    refused, rejects = set(), [spark.createDataFrame([], REJECTED_ROWS)]
    for delivery in deliveries:
        try:
            if delivery.is_delimited:
                frame, rejected = _delimited(spark, delivery, keep)
                rejects.append(rejected)
            else:
                frame = read_parquet_delivery(spark, delivery.path)
        except (PySparkException, Py4JJavaError) as error:  # a broken footer surfaces as the latter
            if "AccessControlException" in str(error):
                raise
            frames[delivery] = None
            refused.add(delivery)
            reasons.append((delivery.month, "UNREADABLE_FILE"))
            continue
        frames[delivery] = with_lineage(frame, delivery)
        present = {c.lower() for c in frame.columns}
        if not present.issuperset(c.lower() for c in contract.required_columns):
            refused.add(delivery)
            reasons.append((delivery.month, "MISSING_REQUIRED_COLUMNS"))
    rejected = keep("rejected_rows", reduce(DataFrame.unionByName, rejects))
    issues = spark.createDataFrame(reasons, ISSUES).unionByName(
        rejected.select("_delivery_month", F.lit("REJECTED_ROWS").alias("reason")).distinct()
    )
    return Arrivals(frames, rejected, keep("arrival_issues", issues), frozenset(refused))
