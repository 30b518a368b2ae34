"""Bit filters keep lines without a partner out of shuffles, and never change a result."""

from __future__ import annotations

import random

import pytest
from conftest import collected, explained

from feedgate import FeedContract
from feedgate.functions import filters
from feedgate.operators import versions

KEY = ["claim_id", "claim_line"]
CONTRACT = FeedContract()


@pytest.fixture
def keyed(spark):
    """Key 'HOT' and the incomplete one many times, key 'D' twice, 40 keys once."""
    hot = [("HOT", 1)] * 6 + [(None, 1)] * 5 + [("D", None)] * 2
    return spark.createDataFrame(hot + [(f"S{i}", i) for i in range(40)], "claim_id string, claim_line int")


@pytest.mark.parametrize("bits", [64, 1 << 20])
def test_all_rows_of_a_recurring_key_are_candidates(keyed, monkeypatch, bits):
    monkeypatch.setattr(filters, "FILTER_BITS", bits)
    words = filters.recurring_filter(keyed, KEY)
    kept, left = filters.candidates(keyed, words, KEY), filters.others(keyed, words, KEY)
    several = [tuple(r) for r in keyed.where("claim_id is null or claim_id in ('HOT', 'D')").collect()]
    found = collected(kept, *KEY)
    assert [r for r in found if r in set(several)] == sorted(several, key=repr)
    assert sorted(found + collected(left, *KEY), key=repr) == collected(keyed, *KEY)
    if bits > 64:
        assert len(found) == len(several)


def _random_lines(seed: int) -> list[dict]:
    rng = random.Random(seed)
    return [
        {
            "claim_id": rng.choice(["A", "B", "C", "D", "E", "F", "G", None]),
            "claim_line": rng.choice(["1", "2", "3", None]),
            "units": str(rng.randrange(3)),
            "claim_freq_code": rng.choice(["1", "1", "7"]),
            "original_claim_id": rng.choice([None, "A", "F"]),
            "member_token": rng.choice(["T1", "T2", "TX", None]),
            "patient_id": rng.choice(["P1", "P2"]),
            "charge_amount": rng.choice(["5.00", "much"]),
            "month": rng.choice(["2025-01", "2025-02", "2025-03"]),
        }
        for _ in range(50)
    ]


EXTENDED = {"extended_warnings": True, "blocking_reasons": ("EMPTY_DELIVERY",)}
OUTCOMES = ("repeated", "conflicts", "latest", "replaced", "exceptions", "silver_lines", "quarantine_lines", "reconciliation", "incomplete_keys")


@pytest.mark.parametrize("contract", [{"blocking_reasons": ("EMPTY_DELIVERY",)}, EXTENDED], ids=["plain", "extended"])
def test_filters_change_no_stage(feed, monkeypatch, contract):
    """With and without filters of exceptions and marks, which short tables go without; against ranking of all lines."""
    rows = _random_lines(len(contract))
    plain = feed(*rows, **contract)
    monkeypatch.setattr(filters, "FILTER_BITS", 64)
    monkeypatch.setattr(filters, "FILTER_FROM", 0)
    plan = feed(*rows, **contract)
    for stage in OUTCOMES:
        columns = [c for c in getattr(plan, stage).columns if c != "_line_id"]
        assert columns == [c for c in getattr(plain, stage).columns if c != "_line_id"]
        assert collected(getattr(plan, stage), *columns) == collected(getattr(plain, stage), *columns), stage
    whole = versions.latest_versions(versions.earliest_copies(plan.slim, CONTRACT), CONTRACT)
    assert collected(plan.latest, "_line_id") == collected(whole, "_line_id")


def test_only_candidates_are_shuffled_to_the_exceptions(spark, feed, monkeypatch):
    """The wide lines that cannot be exceptions reach silver without a shuffle."""
    monkeypatch.setattr(filters, "FILTER_FROM", 0)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = feed(*[{"claim_id": f"S{i}"} for i in range(20)], {"claim_id": "B"}, {"claim_id": "B"})
        text = explained(plan.silver_lines)
        assert "Union" in text and "/excepted_ids" in text
        assert plan.silver_lines.count() == 21
        moved = filters.candidates(plan.accepted, plan._excepted_ids, ["_line_id"])
        assert collected(moved, "claim_id") == [("B",)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_only_lines_of_recurring_keys_are_ranked(feed):
    plan = feed(*[{"claim_id": f"S{i}"} for i in range(20)], {"claim_id": "B"}, {"claim_id": "B", "month": "2025-02"})
    several = filters.candidates(plan.slim, plan.recurring, KEY)
    assert collected(several, "claim_id") == [("B",), ("B",)]
    assert "/recurring" in explained(versions.latest_lines(plan.slim, CONTRACT, plan.recurring))
    assert plan.latest.count() == 21


def test_filters_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(filters, "FILTER_BITS", 1 << 10)
    assert filters.bit_filter(spark.range(20_000), ["id"]).count() == (1 << 10) // filters.WORD_BITS
