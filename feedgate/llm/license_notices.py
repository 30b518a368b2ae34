"""Operator 12: licence notices in texts, also edited ones, by exact seeds and bounded-error matching.

Texts are compared as words: A-Z lower-cased, every run of other ASCII characters than letters and digits one space. A
notice of n characters may differ in n // EDIT_EVERY of them (inserted, deleted or replaced). Cut into one piece more
than that, it leaves at least one piece whole in every edited copy (pigeonhole). One pass of an Aho-Corasick automaton
over all pieces of all notices finds the places; around them the ``regex`` library matches the whole notice within
its bound and counts the edits. A match begins and ends at word boundaries. Phrases are found in the same pass,
exactly and at every place.

Defined results: null or empty text has no words and no spans. Repeated rows and null ids get a result each. Only the
two named columns are read, so others may have any name. An empty table gives an empty result. Windows around seeds have
a bounded length, and memory grows with the longest single text only.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache, lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedgate.llm.batches import bounded_batches, slices

# The phrases of the base and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of public licences, as words.
NOTICES = (
    ("gpl", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("apache", "apache license version 2 0"),
    ("apache", "licensed under the apache license"),
    ("mit", "licensed under the mit license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "3 clause bsd license"),
    ("bsd", "2 clause bsd license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("mpl", "mozilla public license"),
    ("epl", "eclipse public license"),
    ("boost", "boost software license"),
    ("unlicense", "free and unencumbered software released into the public domain"),
    ("cc-by", "creative commons attribution"),
    ("cc-by-nc", "cc by nc"),
    ("cc-by-sa", "cc by sa"),
    ("cc-by-nd", "cc by nd"),
    ("cc0", "cc0 1 0 universal"),
)
EDIT_EVERY = 12

# A to Z go to a to z, all ASCII but letters and digits to a space; other bytes stay.
PLAIN = bytes((c + 32 if 65 <= c <= 90 else c) if c > 127 or chr(c).isalnum() else 32 for c in range(256))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SPAN = pa.struct(
    [
        ("label", pa.string()),
        ("notice", pa.string()),
        ("base", pa.bool_()),
        ("word", pa.int64()),
        ("start", pa.int64()),
        ("end", pa.int64()),
        ("edits", pa.int32()),
    ]
)
SPANS = "array<struct<label:string,notice:string,base:boolean,word:long,start:long,end:long,edits:int>>"


def plain_words(text: str) -> str:
    """The words of a text, each with a space before it and one after the last."""
    out = b" " + text.encode("utf-8", "surrogatepass").translate(PLAIN) + b" "
    while b"  " in out:
        out = out.replace(b"  ", b" ")
    return out.decode("utf-8", "surrogatepass")


def pieces(notice: str, errors: int) -> list[tuple[int, str]]:
    """A notice cut into ``errors + 1`` pieces of about one length, with their places."""
    cuts = [len(notice) * i // (errors + 1) for i in range(errors + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Finder:
    """One automaton over the pieces of all notices and the phrases."""

    def __init__(self, phrases: dict[str, str], notices: tuple[tuple[str, str], ...], edit_every: int):
        self.phrases, self.notices = phrases, notices
        self.errors = [len(text) // edit_every for _, text in notices]
        self.automaton = ahocorasick.Automaton()
        keys: dict[str, list[tuple[int | None, int | str]]] = {}
        for phrase in phrases:
            keys.setdefault(f" {phrase} ", []).append((None, phrase))
        for i, (_, text) in enumerate(notices):
            for at, piece in pieces(text, self.errors[i]):
                keys.setdefault(piece, []).append((i, at))
        for key, uses in keys.items():
            self.automaton.add_word(key, (len(key), uses))
        self.automaton.make_automaton()
        # The space before a match is part of it, the one behind may begin the next.
        self.patterns = [
            regex.compile(f"(?e) (?P<notice>(?:{regex.escape(text)}){{e<={k}}})(?= )")
            for (_, text), k in zip(notices, self.errors, strict=True)
        ]
        self.matches = lru_cache(maxsize=10_000)(self._matches)

    def _matches(self, i: int, window: str) -> list[tuple[int, int, int]]:
        """(start, end, edits) of a notice inside a window."""
        return [(m.start("notice"), m.end("notice"), sum(m.fuzzy_counts)) for m in self.patterns[i].finditer(window)]

    def find(self, words: str) -> set[tuple[int, int, int, str, bool]]:
        """(start, end, edits, notice, of the base) of all spans in ``plain_words``."""
        found, starts = set(), {}
        for last, (length, uses) in self.automaton.iter(words):
            at = last + 1 - length
            for i, what in uses:
                if i is None:
                    found.add((at + 1, last, 0, what, True))
                else:
                    starts.setdefault(i, []).append(at - what)
        for i, places in starts.items():
            text, k = self.notices[i][1], self.errors[i]
            for low, high in _clusters(sorted(places), k):
                begin = max(0, low - k - 1)
                for a, b, edits in self.matches(i, words[begin : high + len(text) + k + 1]):
                    found.add((begin + a, begin + b, edits, text, False))
        return found


def _clusters(places: list[int], gap: int) -> Iterator[tuple[int, int]]:
    """First and last of each group of places that are at most ``gap`` apart."""
    low = high = places[0]
    for at in places[1:]:
        if at - high > gap:
            yield low, high
            low = at
        high = at
    yield low, high


@cache
def finder(notices: tuple[tuple[str, str], ...], edit_every: int) -> Finder:
    return Finder(PHRASES, notices, edit_every)


def spans_of(text: str | None, by: Finder) -> tuple[int, list[tuple]]:
    """The number of words, and (label, notice, base, word, start, end, edits) by place; places are code points of the text."""
    words = plain_words(text or "")
    found = sorted(by.find(words))
    labels = by.phrases | {text: label for label, text in by.notices}
    first, passed, out = 0, 0, []
    for start, end, edits, notice, base in found:
        first += words.count(" ", passed, start)
        passed = start
        out.append((labels[notice] if not base else by.phrases[notice], notice, base, first - 1, first - 1 + words.count(" ", start, end), edits))
    asked = {w for _, _, _, a, b, _ in out for w in (a, b)}
    places = {i: m.span() for i, m in zip(range(max(asked, default=-1) + 1), WORD.finditer(text or ""), strict=False) if i in asked}
    spans = [(label, notice, base, a, places[a][0], places[b][1], edits) for label, notice, base, a, b, edits in out]
    return max(0, words.count(" ") - 1), spans


def _run(notices: tuple[tuple[str, str], ...], edit_every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = finder(notices, edit_every)
        for batch in batches:
            for part in slices(batch, "text"):
                each = [spans_of(text.as_py(), by) for text in part.column("text")]
                flat = [dict(zip(SPAN.names, span, strict=True)) for _, spans in each for span in spans]
                ends = pa.array([0, *_summed(len(spans) for _, spans in each)], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([n for n, _ in each], pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(flat, SPAN)),
                    ],
                    ["doc_id", "n_words", "spans"],
                )

    return run


def _summed(sizes: Iterator[int]) -> Iterator[int]:
    total = 0
    for size in sizes:
        total += size
        yield total


def license_notices(docs: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES, edit_every: int = EDIT_EVERY) -> DataFrame:
    """``doc_id, n_words, spans`` for every row of ``docs(doc_id, text)``.

    A span has its label and notice, whether it is a phrase of the base, the number of its first word, its place in the
    text and its edits.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_run(notices, edit_every), f"doc_id {kind}, n_words long, spans {SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """Counts, labels and score of what ``license_notices`` returns; the score is that of the closest match, 1 for an exact one."""

    def labels(of: str):
        return F.expr(f"array_join(array_sort(array_distinct(transform({of}, x -> x.label))), ',')")

    places = "transform(filter(spans, x -> x.base), x -> x.word)"
    return found.select(
        "doc_id",
        "n_words",
        F.expr("cast(size(filter(spans, x -> x.base)) as long)").alias("n_base"),
        F.expr(f"array_min({places})").alias("first_word"),
        F.expr(f"array_max({places})").alias("last_word"),
        labels("filter(spans, x -> x.base)").alias("base_labels"),
        labels("spans").alias("labels"),
        F.expr("coalesce(array_max(transform(spans, x -> 1D - x.edits / length(x.notice))), 0D)").alias("score"),
    )
