"""Large groups of near copies: every link counts once, and no threshold wraps its registers."""

from __future__ import annotations

import numpy as np
import pytest
from test_operators import brute_components, documents, prose

from feedgate.llm import near_dedup
from feedgate.plans.workspace import Workspace


def edited(rng, words, edits):
    own = list(words)
    for _ in range(edits):
        own[rng.integers(0, len(own))] = f"e{rng.integers(0, 10**6)}"
    return " ".join(own)


@pytest.mark.parametrize("copies", [150, 450])
def test_pairs_grow_with_the_group(spark, monkeypatch, copies):
    """Copies with one word edited: at most a few compared pairs a copy, whatever the size of the group."""
    rng, tried = np.random.default_rng(7), []
    base = prose(rng, 120).split()
    rows = [(i, edited(rng, base, 1)) for i in range(copies)] + [(copies + i, prose(rng, 60)) for i in range(40)]
    keep = Workspace.keep

    def counted(self, name, df, partition=None):
        table = keep(self, name, df, partition)
        if name.endswith("_pairs"):
            tried.append(table.count())
        return table

    monkeypatch.setattr(Workspace, "keep", counted)
    found = near_dedup.near_duplicates(documents(spark, rows), 3, 85).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute_components(rows, 3, 85)
    assert sum(tried) <= 3 * copies


def test_chains_and_large_mixed_buckets(spark, monkeypatch):
    """Drifting copies link only to their neighbours; blocks of few rows still give whole components."""
    monkeypatch.setattr(near_dedup, "JOIN_UP_TO", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 5)
    rng, rows = np.random.default_rng(3), []
    for group in range(3):
        words = prose(rng, 90).split()
        for i in range(40):
            words[rng.integers(0, 90)] = f"g{group}x{rng.integers(0, 10**6)}"
            rows.append((100 * group + i, " ".join(words)))
    found = near_dedup.near_duplicates(documents(spark, rows), 3, 85).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute_components(rows, 3, 85)


@pytest.mark.parametrize("percent", [50, 70])
def test_low_thresholds_keep_their_registers_apart(spark, percent):
    rng, base = np.random.default_rng(percent), []
    for _ in range(4):
        base.append(prose(rng, 50).split())
    rows = [(i, edited(rng, base[i % 4], int(rng.integers(0, 9)))) for i in range(60)]
    found = near_dedup.near_duplicates(documents(spark, rows), 3, percent).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute_components(rows, 3, percent)
    registers = near_dedup.bands_for(percent) * near_dedup.BAND_ROWS
    sets = [near_dedup.mix(np.arange(a, a + 200, dtype=np.uint64)) for a in (0, 1000)]
    sig = near_dedup.signatures(np.concatenate(sets), np.repeat([0, 1], 200), 2, registers)
    assert registers > 255 and not (sig[0] == sig[1]).any() and (sig < np.iinfo(np.int64).max).all()


def test_thresholds_that_need_too_many_registers_are_refused():
    for percent in (0, 20, 100):
        with pytest.raises(ValueError, match="threshold"):
            near_dedup.bands_for(percent)


def test_slices_of_elements_give_the_same_signature(monkeypatch):
    elements = near_dedup.mix(np.arange(5000, dtype=np.uint64))
    doc = np.repeat([0, 1, 2], [10, 4000, 990])
    whole = near_dedup.signatures(elements, doc, 3, 105)
    monkeypatch.setattr(near_dedup, "SLICE", 37)
    assert (near_dedup.signatures(elements, doc, 3, 105) == whole).all()
