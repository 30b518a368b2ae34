"""Conflicts are looked for among the keys a delivery repeats; hashes travel packed to the exceptions."""

from __future__ import annotations

import pytest
from conftest import collected, explained

from feedgate.operators import measures

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.mark.parametrize("broadcast", [True, False])
def test_only_repeated_keys_are_compared_for_conflicts(spark, feed, broadcast):
    rows = [
        {},
        {"claim_id": "B"},
        {"claim_id": "B"},
        {"claim_id": "C"},
        {"claim_id": "C", "month": "2025-02", "units": "2"},
        {"claim_id": "E"},
        {"claim_id": "E", "units": "2"},
        {"claim_id": None},
        {"claim_id": None, "units": "2"},
        {"claim_id": "F", "claim_line": None},
        {"claim_id": "F", "claim_line": None, "units": "3"},
    ]
    before = spark.conf.get(THRESHOLD)
    try:
        spark.conf.set(THRESHOLD, before if broadcast else "-1")
        plan = feed(*rows)
        assert sorted(r.claim_id or "" for r in plan.repeated.collect()) == ["", "B", "E", "F"]
        found = collected(plan.conflicts, "claim_id", "claim_line", "_delivery_month")
    finally:
        spark.conf.set(THRESHOLD, before)
    plain = measures.same_delivery_conflicts(plan.identified, plan.contract)
    assert found == collected(plain, "claim_id", "claim_line", "_delivery_month")
    assert [row[0] for row in found] == ["E", "F", None]


def test_lines_of_a_conflict_check_are_met_on_written_keys(feed):
    """One small table decides whose hashes are shuffled."""
    plan = feed({}, {"claim_id": "B"}, {"claim_id": "B"})
    text = explained(measures.same_delivery_conflicts(plan.identified, plan.contract, plan.repeated))
    assert "/repeated" in text and "LeftSemi" in text


def test_hashes_travel_packed_to_the_exceptions(feed):
    plan = feed({}, {"claim_id": "B"}, {"claim_id": "B"}, {"claim_id": "B", "units": "2", "month": "2025-02"})
    lines = plan.silver_lines.select("claim_id", "_row_hash")
    assert "unhex" in lines._jdf.queryExecution().optimizedPlan().toString()
    hashes = {r._row_hash for r in plan.identified.where("claim_id = 'A' or units = 2").collect()}
    assert {r._row_hash for r in plan.silver_lines.collect()} == hashes and len(hashes) == 2
