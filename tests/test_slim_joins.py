"""What travels when a join is too large to be broadcast, and that the results stay the same."""

from __future__ import annotations

import re

import pytest
from conftest import collected, explained

from checks import fixture
from feedgate.plans.workspace import Workspace
from feedgate.sources.deliveries import read_feed

SF_DIR = "/root/testdata/sf0.001"
THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture
def shuffled(spark):
    """No table is small enough for a broadcast, but those that are broadcast by hint."""
    before = spark.conf.get(THRESHOLD)
    spark.conf.set(THRESHOLD, "-1")
    yield
    spark.conf.set(THRESHOLD, before)


def travelling(df) -> list[str]:
    """The columns that each shuffle of a plan moves."""
    nodes = re.findall(r"\n\(\d+\) Exchange\n(.*?)\n\n", explained(df), re.S)
    return [re.search(r"\[(.*)\]", node.split("\n")[0]).group(1) for node in nodes]


LINES = (
    {"dx_code": None},
    {"month": "2025-02"},
    {"claim_id": "B", "units": "0", "patient_id": "P2"},
    {"claim_id": "C", "member_token": "T2"},
    {"claim_id": "D", "member_token": "T2", "charge_amount": "much"},
    {"claim_id": "E", "member_token": "T2"},
    {"claim_id": "E", "member_token": "T2", "units": "2"},
)
EXTENDED = {"extended_warnings": True, "blocking_reasons": ("EMPTY_DELIVERY",)}
GRADES = [
    ("A", "2025-01", "DX_MISSING|GLOBAL_KEY_DUP|TOKEN_PATIENT_AMBIGUOUS"),
    ("A", "2025-02", "GLOBAL_KEY_DUP|TOKEN_PATIENT_AMBIGUOUS"),
    ("B", "2025-01", "UNITS_INVALID|TOKEN_PATIENT_AMBIGUOUS"),
    ("C", "2025-01", ""),
    ("D", "2025-01", "MONEY_FAIL"),
    ("E", "2025-01", "SAME_MONTH_CONFLICT"),
    ("E", "2025-01", "SAME_MONTH_CONFLICT"),
]


def test_grades_do_not_shuffle_what_warnings_are_found_in(feed, shuffled):
    plan = feed(*LINES, **EXTENDED)
    grades = plan.disposed.select("claim_id", "_delivery_month", "_row_hash", "_dq_status", "_dq_reasons")
    moved = travelling(grades)
    assert any("_line_codes" in columns for columns in moved)
    assert not any(c in columns for columns in moved for c in ("dx_code", "units", "paid_date", "charge_amount", "npi"))
    assert collected(grades, "claim_id", "_delivery_month", "_dq_reasons") == GRADES
    assert collected(grades, "_row_hash") == collected(plan.identified, "_row_hash")
    assert "_line_codes" not in plan.disposed.columns


def test_grades_are_the_same_with_broadcast_marks(feed):
    plan = feed(*LINES, **EXTENDED)
    assert collected(plan.disposed, "claim_id", "_delivery_month", "_dq_reasons") == GRADES


def test_text_deliveries_are_compressed_and_read_whole(spark, tmp_path):
    deliveries, _ = fixture.write_deliveries(spark, SF_DIR, str(tmp_path / "in"))
    sent = next(d for d in deliveries if d.month == "2025-09")
    parts = [p.name for p in (tmp_path / "in" / sent.name).glob("part-*")]
    assert parts and all(name.endswith(".csv.gz") for name in parts)
    raw = fixture.raw_claims(spark, SF_DIR).where("_delivery_month = '2025-09'").drop("_source_file", "_delivery_month")
    read = Workspace(spark, "text").keep("read", read_feed(spark, [sent]))
    assert collected(read, *raw.columns) == collected(raw, *raw.columns)
