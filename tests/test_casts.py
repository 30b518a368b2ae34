"""Safe casts agree with the SQL engine the agreement was written for."""

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedgate.functions.casts import as_text, contracted, safe_date, safe_int, safe_money

INTEGERS = ["1", " 7 ", "+5", "-5", "1.5", "2.5", "-2.5", "2.0", "1e3", "0.5", "-0.4", "", " ", "abc",
            "0.49999999999", "2.49999999999", "2147483647", "2147483648", "99999999999", "12x", "1,000", None]
MONEY = ["12.345", "-0.005", "1,234.50", " 5.1 ", "1e3", "", "abc", "9999999999.99", "10000000000", "0", None]
DATES = ["2025-01-05", "2025/01/05", "2025 01 05", "2025-1-5", "2025", "2025-01", "2025-02-30", "", "x",
         " 2025-01-05 ", "2025-01-05 10:30:00", "2025-01-05T10:30:00", "2025-01/05", "20250105",
         "05-01-2025", "2025-13-01", None]


@pytest.mark.parametrize(
    "texts, cast, sql_type",
    [(INTEGERS, safe_int, "INTEGER"), (MONEY, safe_money, "DECIMAL(12,2)"), (DATES, safe_date, "DATE")],
)
def test_casts_match(spark, texts, cast, sql_type):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    ours = {r.t: r.v for r in df.select("t", cast(F.col("t")).alias("v")).collect()}
    engine = duckdb.connect()
    theirs = {t: engine.execute(f"SELECT TRY_CAST(? AS {sql_type})", [t]).fetchone()[0] for t in texts}
    assert ours == theirs


def test_physical_types_go_through_text(spark):
    df = spark.sql("SELECT 2.5D AS d, 123 AS i, DATE'2025-01-05' AS day, TIMESTAMP'2025-01-05 10:00:00' AS ts")
    row = df.select(
        contracted(F.col("d"), T.DoubleType(), T.IntegerType()).alias("rounded"),
        contracted(F.col("d"), T.DoubleType(), T.DecimalType(12, 2)).alias("money"),
        contracted(F.col("i"), T.IntegerType(), T.StringType()).alias("text"),
        contracted(F.col("day"), T.DateType(), T.DateType()).cast("string").alias("day"),
        contracted(F.col("ts"), T.TimestampType(), T.DateType()).cast("string").alias("ts"),
        contracted(F.col("i"), T.IntegerType(), T.DateType()).alias("no_date"),
    ).first()
    assert (row.rounded, str(row.money), row.text, row.day, row.ts, row.no_date) == (
        3, "2.50", "123", "2025-01-05", "2025-01-05", None,
    )


def test_whole_doubles_keep_their_form(spark):
    values = [1234567890.0, 10000000.0, 0.5, 123456.789, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ours = [r.t for r in df.select(as_text(F.col("v"), T.DoubleType()).alias("t")).collect()]
    engine = duckdb.connect()
    assert ours == [
        engine.execute("SELECT CAST(CAST(? AS DOUBLE) AS VARCHAR)", [v]).fetchone()[0] for v in values
    ]
