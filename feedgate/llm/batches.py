"""Bounded Arrow batches: texts are long, so a batch holds fewer rows than Spark's default."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

ROWS = 1000
SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
SLICE_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's rows per batch to ROWS; a smaller setting stays."""
    if not 0 < int(spark.conf.get(SETTING)) <= ROWS:
        spark.conf.set(SETTING, ROWS)


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts have about SLICE_BYTES together, or one longer text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    at, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > SLICE_BYTES:
            yield batch.slice(at, i - at)
            at, held = i, 0
        held += size
    if at < batch.num_rows:
        yield batch.slice(at)
