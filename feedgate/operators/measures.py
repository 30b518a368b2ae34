"""Measure every delivery against the contract and look for keys that should not repeat."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedgate.contract import FeedContract
from feedgate.functions.columns import blank, is_delimited, share, verdict


def _length_is(column: str, expected: int):
    return F.length(F.coalesce(F.col(column), F.lit(""))) == expected


def contract_measures(identified: DataFrame, contract: FeedContract) -> DataFrame:
    """One row per delivery with its rates and clause verdicts.

    Takes lines that already carry the token flags, so a single aggregation answers all clauses; each
    task sends one partial row per delivery.
    """
    c = contract
    required = (
        ~blank(F.col("claim_id"))
        & F.col("claim_line").isNotNull()
        & F.col("date_of_service").isNotNull()
        & F.col("charge_amount").isNotNull()
    )
    rates = {
        "dx_populated": ~blank(F.col("dx_code")),
        "npi_populated": ~blank(F.col("npi")),
        "token_populated": ~blank(F.col("member_token")),
        "required_populated": required,
        "token_v2_rate": F.col("token_version") == c.token_version,
        "gender_valid_rate": F.col("gender").isin(*c.genders),
        "icd10_rate": (F.col("icd_version") == c.icd_version) & F.col("dx_code").isNotNull(),
        "npi_len_rate": _length_is("npi", c.npi_length),
        "zip_len_rate": _length_is("member_zip", c.zip_length),
        "pos_len_rate": _length_is("place_of_service", c.place_length),
        "date_order_rate": (F.col("date_of_service") <= F.col("paid_date")) | F.col("paid_date").isNull(),
        "units_valid_rate": (F.col("units") >= 1) | F.col("units").isNull(),
        "token_resolution_rate": F.col("_token_known") & ~F.col("_token_ambiguous"),
    }
    measured = identified.groupBy("_delivery_month").agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[share(predicate).alias(name) for name, predicate in rates.items()],
        F.max(is_delimited(F.col("_source_file")).cast("int")).alias("is_csv"),
        F.max((F.col("_physical_format") == "parquet").cast("int")).alias("_is_parquet"),
    )
    # Numeric buffers only: a string maximum would turn the hash aggregation into a sort.
    highest = F.when(F.col("_is_parquet") == 1, F.lit("parquet")).otherwise(F.lit("csv"))
    measured = measured.select(
        "_delivery_month", "total_rows", *rates, "is_csv", highest.alias("physical_format")
    )
    scaled = F.col("total_rows") * F.lit(c.sample_factor)
    return measured.withColumns(
        {
            "scaled_row_count": scaled,
            "clause_2_2": verdict(scaled >= c.min_claim_lines),
            "clause_2_4": verdict(F.col("is_csv") == 0),
            "clause_3_1": verdict(F.col("dx_populated") >= c.dx_min),
            "clause_3_2": verdict(F.col("npi_populated") >= c.npi_min),
            "clause_3_3": verdict(F.col("token_populated") >= c.token_min),
            "clause_3_4": verdict(F.col("required_populated") >= c.required_min),
            "clause_4_2": verdict(F.col("gender_valid_rate") == 1.0),
            "clause_5_4": verdict(F.col("token_v2_rate") == 1.0),
            "clause_5_2": verdict(F.col("token_resolution_rate") >= c.resolution_min),
        }
    )


def volume_band(measures: DataFrame, contract: FeedContract) -> DataFrame:
    """Compare each delivery with the mean of the deliveries present before it.

    The window is not partitioned: its input is one row per delivery.
    """
    calendar = Window.orderBy("_delivery_month")
    n = contract.band_window
    mean = F.avg("total_rows").over(calendar.rowsBetween(-n, -1))
    inside = F.col("total_rows").between(
        F.col("prior_three_mean") * (1 - contract.volume_band),
        F.col("prior_three_mean") * (1 + contract.volume_band),
    )
    lengths_conform = (
        (F.col("npi_len_rate") == 1.0) & (F.col("zip_len_rate") == 1.0) & (F.col("pos_len_rate") == 1.0)
    )
    placed = measures.withColumns(
        {
            "prior_three_mean": mean,
            "delivery_number": F.row_number().over(calendar).cast("bigint"),
        }
    )
    return placed.withColumns(
        {
            "clause_2_3": F.when(F.col("delivery_number") <= n, F.lit("NOT_APPLICABLE")).otherwise(
                verdict(inside)
            ),
            "clause_2_1": F.lit("UNTESTABLE"),
            "clause_2_5": F.lit("UNTESTABLE"),
            "clause_4_1": verdict(F.col("icd10_rate") == 1.0),
            "clause_4_3": verdict(lengths_conform),
            "clause_4_4": verdict(F.col("date_order_rate") == 1.0),
            "clause_4_7": verdict(F.col("units_valid_rate") == 1.0),
        }
    )


def cast_failures(lines: DataFrame, contract: FeedContract) -> DataFrame:
    """Lines of each delivery whose text did not fit the type, one count per typed column."""
    counts = [
        F.count_if(F.col("_misfits").bitwiseAND(F.lit(1 << i)) != 0).alias(f"{c}_failed")
        for i, c in enumerate(contract.cast_columns)
    ]
    return lines.groupBy("_delivery_month").agg(F.count(F.lit(1)).alias("total_rows"), *counts)


def global_key_dupes(lines: DataFrame, contract: FeedContract) -> DataFrame:
    """Complete keys seen more than once: in how many deliveries, and in how many rows."""
    key = list(contract.line_key)
    per_delivery = (
        lines.dropna(subset=key)
        .groupBy(*key, "_delivery_month")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    return (
        per_delivery.groupBy(*key)
        .agg(F.count("_delivery_month").alias("delivery_count"), F.sum("_rows").alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def repeated_in_delivery(lines: DataFrame, contract: FeedContract) -> DataFrame:
    """Keys with several lines in one delivery; incomplete keys count as keys here."""
    key = [*contract.line_key, "_delivery_month"]
    return lines.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select(*key)


def same_delivery_conflicts(
    lines: DataFrame, contract: FeedContract, repeated: DataFrame | None = None
) -> DataFrame:
    """Keys that carry different content inside one delivery; incomplete keys count as keys here.

    The halves of the hash are compared as numbers, as a string maximum would sort all lines. Only a key of
    ``repeated`` can be in conflict; with that table, best read from a written one, hashes of other lines do not
    travel: Spark broadcasts a small one by its real size and splits the lines of a hot key otherwise.
    """
    key = [*contract.line_key, "_delivery_month"]
    first, second = (F.conv(F.substring("_row_hash", at, 16), 16, -10).cast("bigint") for at in (1, 17))
    hashed = lines.select(*key, first.alias("_first"), second.alias("_second"))
    if repeated is not None:
        named = repeated.select(*[F.col(c).alias(f"_repeated_{c}") for c in key])
        matched = [F.col(c).eqNullSafe(F.col(f"_repeated_{c}")) for c in key]
        hashed = hashed.join(named, reduce(Column.__and__, matched), "left_semi")
    return (
        hashed.groupBy(*key)
        .agg(*[f(c).alias(f"{c}_{f.__name__}") for c in ("_first", "_second") for f in (F.min, F.max)])
        .where("_first_min <> _first_max or _second_min <> _second_max")
        .select(*key)
    )
