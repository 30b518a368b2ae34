"""Roll current lines up to one header per claim."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TOTAL = T.DecimalType(38, 2)


def claim_header(silver: DataFrame) -> DataFrame:
    """One row per claim with at least one current line.

    The person id is the lowest of the claim and the reasons are sorted, so the result does not
    depend on row order. The set holds joined codes, so it is bounded by the number of
    combinations of warning codes.
    """
    reasons = F.array_join(
        F.array_sort(F.collect_set(F.when(F.col("_dq_reasons") != "", F.col("_dq_reasons")))), "|"
    )
    rolled = (
        silver.where("is_current")
        .groupBy("claim_id")
        .agg(
            F.min("vi_pid").alias("vi_pid"),
            F.min("date_of_service").alias("first_date_of_service"),
            F.max("date_of_service").alias("last_date_of_service"),
            F.sum("charge_amount").cast(TOTAL).alias("total_charge_amount"),
            F.sum("allowed_amount").cast(TOTAL).alias("total_allowed_amount"),
            F.count(F.lit(1)).alias("line_count"),
            F.max("_delivery_month").alias("_delivery_month"),
            F.max("_source_file").alias("_source_file"),
            F.max("_ingested_at").alias("_ingested_at"),
            F.when(F.bool_or(F.col("_dq_status") == "WARN"), F.lit("WARN"))
            .otherwise(F.lit("PASS"))
            .alias("_dq_status"),
            F.nullif(reasons, F.lit("")).alias("_dq_reasons"),
            F.bool_and("is_current").alias("all_lines_current"),
        )
    )
    hashed = F.md5(
        F.concat_ws(
            "|",
            "claim_id",
            F.coalesce("vi_pid", F.lit("")),
            F.col("first_date_of_service").cast("string"),
            F.col("last_date_of_service").cast("string"),
            F.col("total_charge_amount").cast("string"),
            F.col("total_allowed_amount").cast("string"),
            F.col("line_count").cast("string"),
        )
    )
    return rolled.withColumn("_row_hash", hashed).select(
        *rolled.columns[:-1], "_row_hash", "all_lines_current"
    )
