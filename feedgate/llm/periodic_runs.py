"""Operator 11: stretches of words that repeat with a period, found by multi-scale minimizers.

A run is a stretch with smallest period q and at least max(6, 4 * q) words that no neighbouring word extends. Words
get exact numbers, and the texts of a slice form one sequence with a word of its own after each text, which no run
can hold.

Periods up to DIRECT are scanned lag by lag. For the others, the scale Q = 16, 32, ... serves periods above Q / 2 and
up to Q: of every window of Q / 2 grams of Q words the least hash is a minimizer. A run is longer than such a window,
a gram and a period together, so some minimizer repeats one period later; a gram as long as the period occurs
nowhere between, so that repeat is the next equal minimizer. Next equal minimizers that are a period of the scale apart
are seeds, and seeds are extended word by word. Every position gives one seed at most, whatever the text.

Gram hashes only choose seeds. Grams that share a hash by accident (about n * n / 4e19 pairs) could hide a run,
never invent one.

Defined results: words are cut at ASCII white space and compared as they are. Null or empty text, and text of white
space only, has no words, no runs and an empty collapsed text. Repeated rows and null ids get a result each. Only the
two named columns are read, so others may have any name. An empty table gives an empty result. Memory grows with
the longest single text, not with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedgate.llm.batches import bounded_batches, slices
from feedgate.llm.words import mix

LEAST_WORDS = 6
LEAST_PERIODS = 4
DIRECT = 8

RUNS = "array<struct<start:long,length:long,period:long>>"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts, and where the words of each text begin and end."""
    cut = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    pieces, offsets = cut.flatten(), cut.offsets.to_numpy() - cut.offsets[0].as_py()
    full = pc.greater(pc.binary_length(pieces), 0)
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return pieces.filter(full), before[offsets]


def _by_lag(ids: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """All maximal stretches in which words ``lag`` apart are equal."""
    edges = np.diff((ids[lag:] == ids[:-lag]).astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + lag


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every window of ``width`` values, a power of two."""
    step = 1
    while step < width:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def minimizers(grams: np.ndarray, width: int) -> np.ndarray:
    """Places whose hash is the least of some window, all places of equal least hashes included."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    rim = np.zeros(width - 1, np.uint64)
    least = np.concatenate([rim, _sliding(grams, width, np.minimum), rim])
    return np.flatnonzero(_sliding(least, width, np.maximum) == grams)


def _seeds(grams: np.ndarray, scale: int) -> np.ndarray:
    """(lag, place) of next equal minimizers whose distance is a period of the scale, sorted."""
    at = minimizers(grams, scale // 2)
    at = at[np.argsort(grams[at], kind="stable")]
    lag = np.diff(at)
    near = (grams[at[1:]] == grams[at[:-1]]) & (lag > scale // 2) & (lag <= scale)
    found = np.stack([lag[near], at[:-1][near]], axis=1)
    return found[np.lexsort((found[:, 1], found[:, 0]))]


def _reach(one: np.ndarray, two: np.ndarray) -> int:
    """How many leading words agree."""
    at, step, n = 0, 64, min(len(one), len(two))
    while at < n:
        end = min(n, at + step)
        differ = one[at:end] != two[at:end]
        if differ.any():
            return at + int(differ.argmax())
        at, step = end, step * 2
    return n


def _extended(ids: np.ndarray, seeds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """The stretch around each seed; seeds inside the last stretch of their lag are skipped."""
    last, end = 0, 0
    for lag, at in seeds.tolist():
        if lag == last and at + lag < end:
            continue
        start = at - _reach(ids[:at][::-1], ids[: at + lag][::-1])
        last, end = lag, at + lag + _reach(ids[at:], ids[at + lag :])
        yield start, end, lag


def runs_of(ids: np.ndarray, longest: int) -> np.ndarray:
    """(start, end, period) of all runs, by start; no text has more than ``longest`` words."""
    found = [np.zeros((0, 3), np.int64)]

    def add(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        enough = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * period)
        found.append(np.stack([start, end, period], axis=1)[enough])

    for lag in range(1, min(DIRECT, longest // LEAST_PERIODS) + 1):
        start, end = _by_lag(ids, lag)
        add(start, end, np.full(len(start), lag))
    grams, size, scale = mix(ids.astype(np.uint64)), 1, 2 * DIRECT
    while LEAST_PERIODS * (scale // 2 + 1) <= longest:
        while size < scale:
            grams = mix(grams[:-size] ^ mix(grams[size:] + np.uint64(size)))
            size *= 2
        stretches = np.array([*_extended(ids, _seeds(grams, scale))], np.int64).reshape(-1, 3)
        add(*stretches.T)
        scale *= 2
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    # A stretch also shows at multiples of its smallest period.
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def _found(doc_id: pa.Array, texts: pa.Array) -> list[pa.Array]:
    words, bounds = split_words(texts)
    counts = np.diff(bounds)
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    # Text t begins t places later than its words, after the end words of those before it.
    begins = bounds[:-1] + np.arange(len(counts))
    place = np.arange(len(words)) + np.repeat(np.arange(len(counts)), counts)
    ids = -1 - np.arange(len(words) + len(counts), dtype=np.int64)
    ids[place] = numbers
    runs = runs_of(ids, int(counts.max(initial=0)))
    covered = np.zeros(len(ids) + 1, np.int64)
    np.add.at(covered, runs[:, 0] + runs[:, 2], 1)
    np.add.at(covered, runs[:, 1], -1)
    kept = np.cumsum(covered)[place] == 0
    cuts = np.concatenate([[0], np.cumsum(kept)])[bounds]
    left = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words.filter(pa.array(kept)))
    collapsed = pc.binary_join(left, pa.scalar(" ", pa.large_string()))
    of = np.searchsorted(begins, runs[:, 0], "right") - 1
    runs = pa.StructArray.from_arrays(
        [pa.array(x) for x in (runs[:, 0] - begins[of], runs[:, 1] - runs[:, 0], runs[:, 2])], fields=list(RUN)
    )
    ends = pa.array(np.searchsorted(of, np.arange(len(counts) + 1)), pa.int32())
    return [doc_id, pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(ends, runs), collapsed.cast(pa.string())]


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            yield pa.RecordBatch.from_arrays(_found(*part.columns), ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs(doc_id, text)``.

    ``runs`` holds start, length and period of every run in words, by start. ``collapsed`` is the text without the
    words of a run after its first period, joined by one space.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_run, f"doc_id {kind}, n_words long, runs {RUNS}, collapsed string")


def with_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with a stretch repeated to the end in about a tenth of the texts, as crc32 of the id decides.

    Those texts have their words joined by one space; a null id repeats nothing.
    """
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), checksum.alias("_h"), F.expr("0").alias("_"))
    rows = rows.withColumn("_g", F.expr("_h div 10"))
    # The lambda around the words keeps them from being split again for every word.
    repeated = r"""
        array_join(transform(array(filter(split(text, '[\\x20\\x09-\\x0D]+'), x -> x <> '')), w ->
            if(size(w) = 0, '', array_join(transform(sequence(0, size(w) - 1), i ->
                if(i < _g % size(w), w[i],
                   w[cast(_g % size(w) + (i - _g % size(w)) % (1 + (size(w) - _g % size(w)) div (3 + _g % 8)) as int)])), ' '))), '')
    """
    return rows.select("doc_id", F.when(F.col("_h") % 10 == 0, F.expr(repeated)).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the longest run and hashes of what ``periodic_runs`` returns."""
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')"
    longest = "array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))"
    return found.withColumn("_best", F.expr(longest)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"),
        F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"),
        F.sha2(F.expr(lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
