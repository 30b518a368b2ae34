"""Grade accepted lines: pass, warn or quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedgate.contract import FeedContract
from feedgate.functions.columns import LINE_ID, blank
from feedgate.functions.filters import candidates, others

# Bits of ``_marks``: what the other lines of the feed say against a line.
CONFLICT, KEY_DUP, PATIENT_AMBIGUOUS = 1, 2, 4

# The warnings a line shows by itself, found before its marks are joined; NULL when there is none.
LINE_CODES = "_line_codes"


def _line_issues(contract: FeedContract) -> dict[str, Column]:
    """Warnings that a line shows by itself, in fixed order."""
    is_reversal = (F.col("claim_freq_code") == contract.reversal_code) & F.col(
        "original_claim_id"
    ).isNotNull()
    raised = {
        "DX_MISSING": blank(F.col("dx_code")),
        "NPI_MISSING": blank(F.col("npi")),
        "MEMBER_TOKEN_MISSING": blank(F.col("member_token")),
        "TOKEN_UNRESOLVED": F.col("_token_unresolved"),
        "TOKEN_VERSION_INVALID": ~F.col("token_version").eqNullSafe(contract.token_version),
        "GENDER_INVALID": ~F.coalesce(F.col("gender").isin(*contract.genders), F.lit(False)),
        "UNITS_INVALID": F.col("units") < 1,
        "DATE_ORDER_INVALID": F.col("date_of_service") > F.col("paid_date"),
        "NEGATIVE_CHARGE_INVALID": (F.col("charge_amount") < 0) & ~is_reversal,
    }
    if contract.extended_warnings:
        raised |= {
            "DATE_FAIL": _has("_misfits", _bits(contract, contract.date_columns)),
            "MONEY_FAIL": _has("_misfits", _bits(contract, contract.money_columns)),
        }
    return raised


def _mark_issues(contract: FeedContract) -> dict[str, Column]:
    """Warnings that other lines raise; they follow those of the line."""
    if not contract.extended_warnings:
        return {}
    return {
        "GLOBAL_KEY_DUP": _has("_marks", KEY_DUP),
        "TOKEN_PATIENT_AMBIGUOUS": _has("_marks", PATIENT_AMBIGUOUS),
    }


def _raised(issues: dict[str, Column]) -> list[Column]:
    return [F.when(test, F.lit(code)) for code, test in issues.items()]


def warning_codes(contract: FeedContract) -> Column:
    """All warnings of a line in fixed order, joined with '|'; empty when there is none.

    Extended warnings read the bit masks ``_misfits`` and ``_marks`` of the line.
    """
    return F.concat_ws("|", *_raised(_line_issues(contract) | _mark_issues(contract)))


def _bits(contract: FeedContract, columns: Sequence[str]) -> int:
    return sum(1 << i for i, c in enumerate(contract.cast_columns) if c in columns)


def _has(mask: str, bits: int) -> Column:
    return F.col(mask).bitwiseAND(F.lit(bits)) != 0


def line_marks(
    lines: DataFrame,
    contract: FeedContract,
    conflicts: DataFrame | None = None,
    key_dupes: DataFrame | None = None,
    patient_tokens: DataFrame | None = None,
    recurring: DataFrame | None = None,
) -> DataFrame:
    """What other lines say against a line: ``_line_id`` and the bit mask ``_marks``, for marked lines only.

    Each issue table holds a key or a token once, so a join never multiplies lines, and slim lines are all that is
    shuffled. Read from written tables, a small issue table is broadcast by its real size and the lines of a hot
    key or token are split otherwise. Incomplete keys and null tokens match nothing. With ``recurring``, the filter of the
    keys that several lines have, other lines are not compared by key.
    """
    found = []
    several = candidates(lines, recurring, contract.line_key)

    def mark(rows: DataFrame, issues: DataFrame | None, on: list[str], bit: int) -> None:
        if issues is not None:
            hit = rows.select(LINE_ID, *on).join(issues.select(*on), on, "left_semi")
            found.append(hit.select(LINE_ID, F.lit(bit).alias("_mark")))

    mark(several, conflicts, [*contract.line_key, "_delivery_month"], CONFLICT)
    mark(several, key_dupes, list(contract.line_key), KEY_DUP)
    mark(lines, patient_tokens, ["member_token"], PATIENT_AMBIGUOUS)
    return reduce(DataFrame.unionByName, found).groupBy(LINE_ID).agg(F.bit_or("_mark").alias("_marks"))


def hold(
    lines: DataFrame, contract: FeedContract, marks: DataFrame | None = None, marked_ids: DataFrame | None = None
) -> DataFrame:
    """Add ``_held_for``: why a line cannot be trusted, NULL for a line that can.

    ``marks`` may be left out when conflicts block their delivery, as no accepted line can match, and no extended
    warnings are asked for. It is best read from a written table, so that every consumer joins the same slim rows
    on the unique line id: Spark broadcasts few, and spreads many evenly whatever the keys are. The warnings a line
    shows by itself are found before that join (``_line_codes``), so a consumer of the grades alone does not shuffle
    the columns they are found in. ``marked_ids``, the filter of the marked line ids, keeps lines that no mark names out of
    the join altogether.
    """
    ambiguous = F.when(F.col("_token_ambiguous"), F.lit("TOKEN_AMBIGUOUS"))
    if marks is None:
        return lines.withColumns({"_marks": F.lit(0), "_held_for": ambiguous})
    conflict = F.when(_has("_marks", CONFLICT), F.lit("SAME_MONTH_CONFLICT"))
    coded = lines.withColumn(LINE_CODES, F.nullif(F.concat_ws("|", *_raised(_line_issues(contract))), F.lit("")))
    marked = candidates(coded, marked_ids, [LINE_ID]).join(marks.select(LINE_ID, "_marks"), LINE_ID, "left")
    mask = F.coalesce(F.col("_marks"), F.lit(0)).alias("_marks")
    held = marked.select(*coded.columns, mask, F.coalesce(conflict, ambiguous).alias("_held_for"))
    if marked_ids is None:
        return held
    clear = others(coded, marked_ids, [LINE_ID]).withColumns({"_marks": F.lit(0), "_held_for": ambiguous})
    return held.unionByName(clear)


def eligible(held: DataFrame) -> DataFrame:
    """Lines that go on to silver; the test touches one narrow column."""
    return held.where(F.col("_held_for").isNull())


def grade(held: DataFrame, contract: FeedContract) -> DataFrame:
    """Replace ``_held_for`` by ``_dq_status`` and ``_dq_reasons``."""
    status = (
        F.when(F.col("_held_for").isNotNull(), F.lit("QUARANTINE"))
        .when(F.col("_warnings") != "", F.lit("WARN"))
        .otherwise(F.lit("PASS"))
    )
    reasons = F.coalesce(F.col("_held_for"), F.col("_warnings"))
    codes = warning_codes(contract)
    if LINE_CODES in held.columns:
        codes = F.concat_ws("|", F.col(LINE_CODES), *_raised(_mark_issues(contract)))
    return (
        held.withColumn("_warnings", codes)
        .withColumns({"_dq_status": status, "_dq_reasons": reasons})
        .drop("_held_for", "_warnings", "_marks", LINE_CODES)
    )


def row_disposition(
    lines: DataFrame, contract: FeedContract, conflicts: DataFrame | None = None
) -> DataFrame:
    """Every accepted line with its status and reasons."""
    marks = None if conflicts is None else line_marks(lines, contract, conflicts)
    return grade(hold(lines, contract, marks), contract)


def quarantine(held: DataFrame, contract: FeedContract, ingested_at: Column) -> DataFrame:
    """Held lines in the published layout; they are neither current nor superseded."""
    return (
        grade(held.where(F.col("_held_for").isNotNull()), contract)
        .withColumns(
            {"_ingested_at": ingested_at, "is_current": F.lit(False), "is_superseded": F.lit(False)}
        )
        .select(*contract.published_columns)
    )
