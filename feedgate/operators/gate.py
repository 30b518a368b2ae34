"""Decide per delivery: load, load with warnings, or block."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedgate.contract import ARRIVAL_REASONS, GATE_REASONS, FeedContract


def gate_reasons(
    expected: DataFrame, results: DataFrame, conflicts: DataFrame, issues: DataFrame | None = None
) -> DataFrame:
    """Reasons against each expected delivery, also for one that never arrived.

    ``issues`` (``_delivery_month, reason``) says what was wrong on arrival; these reasons come first, and a delivery
    that was not read for one of them is not called empty. All broadcast sides hold at most one row per delivery.
    """
    calendar = expected.select(F.col("delivery_month").alias("_delivery_month"))
    conflicting = conflicts.select("_delivery_month").distinct().withColumn("_conflict", F.lit(True))
    assessed = calendar.join(F.broadcast(results), "_delivery_month", "left").join(
        F.broadcast(conflicting), "_delivery_month", "left"
    )

    if issues is None:
        arrived = {r: F.lit(False) for r in ARRIVAL_REASONS}
    else:
        flags = [F.max(F.col("reason") == r).alias(f"_{r}") for r in ARRIVAL_REASONS]
        flagged = issues.groupBy("_delivery_month").agg(*flags)
        assessed = assessed.join(F.broadcast(flagged), "_delivery_month", "left")
        arrived = {r: F.coalesce(F.col(f"_{r}"), F.lit(False)) for r in ARRIVAL_REASONS}

    def failed(*clauses: str):
        return reduce(or_, [F.coalesce(F.col(c) == "FAIL", F.lit(False)) for c in clauses])

    total = F.coalesce(F.col("total_rows"), F.lit(0))
    raised = arrived | {
        "EMPTY_DELIVERY": (total == 0) & ~reduce(or_, arrived.values()),
        "WRONG_FORMAT": failed("clause_2_4"),
        "COMPLETENESS_FAIL": failed("clause_3_1", "clause_3_2", "clause_3_3", "clause_3_4"),
        "SAME_MONTH_CONFLICT": F.col("_conflict"),
        "DOMAIN_FAIL": failed("clause_4_2"),
        "TOKEN_VERSION_FAIL": failed("clause_5_4"),
        "TOKEN_RESOLUTION_LOW": failed("clause_5_2"),
        "VOLUME_FAIL": failed("clause_2_2"),
        "VOLUME_BAND_FAIL": failed("clause_2_3"),
    }
    reasons = F.array_compact(F.array(*[F.when(raised[r], F.lit(r)) for r in (*ARRIVAL_REASONS, *GATE_REASONS)]))
    return assessed.select(
        "_delivery_month", total.cast("bigint").alias("total_rows"), reasons.alias("all_reasons")
    )


def promotion_decisions(reasons: DataFrame, contract: FeedContract) -> DataFrame:
    blocking = F.array(*[F.lit(r) for r in contract.blocking_reasons])
    decision = (
        F.when(F.arrays_overlap("all_reasons", blocking), F.lit("BLOCK"))
        .when(F.size("all_reasons") > 0, F.lit("LOAD_WITH_WARNINGS"))
        .otherwise(F.lit("LOAD"))
    )
    return reasons.withColumns(
        {"decision": decision, "reason_codes": F.array_join("all_reasons", "|")}
    )
