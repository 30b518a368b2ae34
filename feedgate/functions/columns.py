"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: a delivery is named claims_YYYYMM.
DELIVERY_NAME = r"claims_(\d{4})(\d{2})"

# The unique number of an accepted line, by which slim tables find their way back to it.
LINE_ID = "_line_id"


def delivery_key(path: Column) -> Column:
    """'YYYY-MM' from a delivery path, 'unknown' when the name carries no month."""
    year = F.regexp_extract(path, DELIVERY_NAME, 1)
    month = F.regexp_extract(path, DELIVERY_NAME, 2)
    return F.when(year == "", F.lit("unknown")).otherwise(F.concat_ws("-", year, month))


def is_delimited(path: Column) -> Column:
    return F.coalesce(F.lower(path).endswith(".csv"), F.lit(False))


def physical_format(path: Column) -> Column:
    return F.when(is_delimited(path), F.lit("csv")).otherwise(F.lit("parquet"))


def row_hash(columns: Sequence[str]) -> Column:
    """MD5 over the text of the columns, joined with '|'; NULL and '' hash alike."""
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]))


def blank(column: Column) -> Column:
    """NULL, empty or spaces only."""
    return column.isNull() | (F.trim(column) == "")


def share(predicate: Column) -> Column:
    """Share of all rows of the group that satisfy the predicate; NULL does not satisfy it."""
    return F.count_if(predicate).cast("double") / F.count(F.lit(1))


def verdict(passed: Column) -> Column:
    """PASS or FAIL; an unknown comparison fails."""
    return F.when(passed, F.lit("PASS")).otherwise(F.lit("FAIL"))
