"""The data contract a feed is held to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The contracted columns, in hashing and publication order.
CLAIM_COLUMNS = (
    "claim_id",
    "claim_line",
    "claim_freq_code",
    "original_claim_id",
    "member_token",
    "token_version",
    "patient_id",
    "member_zip",
    "gender",
    "birth_year",
    "dx_code",
    "icd_version",
    "procedure_code",
    "place_of_service",
    "npi",
    "date_of_service",
    "paid_date",
    "charge_amount",
    "allowed_amount",
    "units",
    "claim_type",
    "source_system",
    "delivery_month",
)

# The typed columns; every other contracted column is a string.
INTEGER_COLUMNS = ("claim_line", "birth_year", "units")
MONEY_COLUMNS = ("charge_amount", "allowed_amount")
DATE_COLUMNS = ("date_of_service", "paid_date")

# Gate reasons, in the order they are reported.
GATE_REASONS = (
    "EMPTY_DELIVERY",
    "WRONG_FORMAT",
    "COMPLETENESS_FAIL",
    "SAME_MONTH_CONFLICT",
    "DOMAIN_FAIL",
    "TOKEN_VERSION_FAIL",
    "TOKEN_RESOLUTION_LOW",
    "VOLUME_FAIL",
    "VOLUME_BAND_FAIL",
)

# Reasons that stop a whole delivery.
BLOCKING_REASONS = (
    "EMPTY_DELIVERY",
    "UNREADABLE_FILE",
    "MISSING_REQUIRED_COLUMNS",
    "SAME_MONTH_CONFLICT",
    "TOKEN_AMBIGUOUS",
)


# What can be wrong with a delivery before its lines are looked at; raised when deliveries are judged one by one.
ARRIVAL_REASONS = ("UNREADABLE_FILE", "MISSING_REQUIRED_COLUMNS", "REJECTED_ROWS")


@dataclass(frozen=True)
class FeedContract:
    """Column roles, thresholds, domains and gate codes; the defaults are the published agreement."""

    columns: tuple[str, ...] = CLAIM_COLUMNS
    integer_columns: tuple[str, ...] = INTEGER_COLUMNS
    money_columns: tuple[str, ...] = MONEY_COLUMNS
    date_columns: tuple[str, ...] = DATE_COLUMNS
    line_key: tuple[str, ...] = ("claim_id", "claim_line")

    sample_factor: int = 80
    min_claim_lines: int = 2_000_000
    volume_band: float = 0.25
    band_window: int = 3

    dx_min: float = 0.95
    npi_min: float = 0.98
    token_min: float = 0.99
    required_min: float = 1.0
    resolution_min: float = 0.85

    token_version: str = "v2"
    genders: tuple[str, ...] = ("M", "F", "U")
    icd_version: str = "10"
    npi_length: int = 10
    zip_length: int = 5
    place_length: int = 2
    replacement_code: str = "7"
    reversal_code: str = "8"

    required_columns: tuple[str, ...] = ("claim_id", "claim_line", "date_of_service", "charge_amount")
    blocking_reasons: tuple[str, ...] = (*BLOCKING_REASONS, "REJECTED_ROWS")
    # Also warn of dates and amounts that are no such, repeated keys and tokens of several patients.
    extended_warnings: bool = False

    def type_of(self, column: str) -> T.DataType:
        """The contracted type of one column."""
        if column in self.integer_columns:
            return T.IntegerType()
        if column in self.money_columns:
            return T.DecimalType(12, 2)
        if column in self.date_columns:
            return T.DateType()
        return T.StringType()

    @property
    def cast_columns(self) -> list[str]:
        """The columns whose text can fail to be their type, in contracted order; bit i of ``_misfits`` is the i-th."""
        typed = (*self.integer_columns, *self.money_columns, *self.date_columns)
        return [c for c in self.columns if c in typed]

    @property
    def conflicts_block(self) -> bool:
        """Whether a conflicting key stops its delivery, so that no loaded row can be in conflict."""
        return "SAME_MONTH_CONFLICT" in self.blocking_reasons

    @property
    def published_columns(self) -> list[str]:
        """Columns of the published line and quarantine tables, in order."""
        return [
            *self.columns,
            "vi_pid",
            "_ingested_at",
            "_source_file",
            "_delivery_month",
            "_dq_status",
            "_dq_reasons",
            "_row_hash",
            "is_current",
            "is_superseded",
        ]
