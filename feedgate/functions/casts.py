"""Safe casts: text that does not fit the contracted type becomes NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: year, month and day with one repeated separator, optionally followed by a time.
DATE_TEXT = r"^\s*(\d{4})([-/ ])(\d{1,2})\2(\d{1,2})(\s*|[ T]\d{1,2}:\d.*)$"


def as_text(column: Column, dtype: T.DataType) -> Column:
    """The text of a physically typed column; whole floating-point numbers keep their '.0'."""
    if isinstance(dtype, T.StringType):
        return column
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        whole = (F.abs(column) < F.lit(1e15)) & (column == F.floor(column))
        return F.when(
            whole, F.concat(column.cast("bigint").cast("string"), F.lit(".0"))
        ).otherwise(column.cast("string"))
    return column.cast("string")


def as_text_sql(column: str, dtype: T.DataType) -> str:
    """``as_text`` as SQL, for a view."""
    if isinstance(dtype, T.StringType):
        return column
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        whole = f"abs({column}) < 1e15 AND {column} = floor({column})"
        return f"CASE WHEN {whole} THEN concat(CAST(CAST({column} AS bigint) AS string), '.0') ELSE CAST({column} AS string) END"
    return f"CAST({column} AS string)"


def safe_int(text: Column) -> Column:
    """Whole numbers directly; decimal and exponent forms round half away from zero, once.

    Ten whole digits hold every int, so all other digits can keep the fraction.
    """
    rounded = F.round(text.try_cast(T.DecimalType(38, 28)))
    return F.coalesce(text.try_cast("int"), rounded.try_cast("int"))


def safe_money(text: Column) -> Column:
    return text.try_cast(T.DecimalType(12, 2))


def safe_date(text: Column) -> Column:
    """Calendar dates only: a bare year or year-month is not a date."""
    iso = (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    rewritten = F.when(
        text.rlike(DATE_TEXT), F.regexp_replace(text, DATE_TEXT, "$1-$3-$4")
    )
    return F.when(iso, text.try_cast("date")).otherwise(rewritten.try_cast("date"))


def misfit(column: Column, physical: T.DataType, typed: Column) -> Column:
    """Whether something was sent (not blank) that is not of its contracted type."""
    return typed.isNull() & (F.trim(as_text(column, physical)) != "")


def contracted(column: Column, physical: T.DataType, target: T.DataType) -> Column:
    """Cast a column of any physical type to its contracted type, through text."""
    if isinstance(target, T.DateType) and isinstance(
        physical, (T.DateType, T.TimestampType, T.TimestampNTZType)
    ):
        if isinstance(physical, T.TimestampType):  # the UTC day, whatever the session's zone
            return F.date_from_unix_date(F.floor(F.unix_seconds(column) / 86400).cast("int"))
        return column.cast("date")
    if isinstance(target, T.IntegerType) and isinstance(physical, T.IntegerType):
        return column
    text = as_text(column, physical)
    if isinstance(target, T.IntegerType):
        return safe_int(text)
    if isinstance(target, T.DecimalType):
        return safe_money(text)
    if isinstance(target, T.DateType):
        return safe_date(text)
    return text
