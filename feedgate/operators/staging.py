"""Bring deliveries of different physical schemas into one typed table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedgate.contract import FeedContract
from feedgate.functions.casts import as_text, contracted, misfit
from feedgate.functions.columns import physical_format, row_hash


def alignment(schemas: Sequence[T.StructType]) -> tuple[dict[str, str], set[str]]:
    """The spelling of every column by its lower-case name, in order of appearance, and the names of mixed types."""
    types: dict[str, set[T.DataType]] = {}
    spelling: dict[str, str] = {}
    for schema in schemas:
        for field in schema.fields:
            types.setdefault(field.name.lower(), set()).add(field.dataType)
            spelling.setdefault(field.name.lower(), field.name)
    mixed = {
        name
        for name, seen in types.items()
        if len(seen) > 1 and not all(isinstance(t, T.NumericType) for t in seen)
    }
    return spelling, mixed


def union_deliveries(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, whatever its case; absent columns become NULL and mixed types become text.

    A column keeps the spelling it has in the first frame that holds it.
    Columns are aligned before the union because Spark would otherwise coerce text to a number and
    fail on the first value that is not one.
    """
    spelling, mixed = alignment([frame.schema for frame in frames])

    def aligned(frame: DataFrame) -> DataFrame:
        def column(field: T.StructField):
            name = field.name.lower()
            sent = F.col("`" + field.name.replace("`", "``") + "`")
            return (as_text(sent, field.dataType) if name in mixed else sent).alias(spelling[name])

        return frame.select(*[column(f) for f in frame.schema.fields])

    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [aligned(frame) for frame in frames],
    )


def normalize(staged: DataFrame, contract: FeedContract) -> DataFrame:
    """The contracted columns with safe casts, plus lineage; other vendor columns are dropped.

    Under extended warnings ``_misfits`` is a bit mask of the columns whose text did not fit their type.
    """
    physical = {f.name.lower(): f.dataType for f in staged.schema.fields}
    sent = {c: physical.get(c.lower(), T.StringType()) for c in contract.columns}
    typed = {c: contracted(F.col(c), sent[c], contract.type_of(c)) for c in contract.columns}
    bits = [
        F.when(misfit(F.col(c), sent[c], typed[c]), F.lit(1 << i)).otherwise(F.lit(0))
        for i, c in enumerate(contract.cast_columns)
    ]
    return staged.select(
        *[column.alias(c) for c, column in typed.items()],
        *([reduce(Column.bitwiseOR, bits).alias("_misfits")] if contract.extended_warnings else []),
        "_delivery_month",
        "_source_file",
        physical_format(F.col("_source_file")).alias("_physical_format"),
    )


def with_row_hash(lines: DataFrame, contract: FeedContract) -> DataFrame:
    return lines.withColumn("_row_hash", row_hash(contract.columns))
