"""Operator 7: benchmark decontamination with rare n-gram seeds and Smith-Waterman alignment.

The corpus frequency of every word n-gram of the benchmark is counted over all documents. A copy that still
reaches the least score has lost a limited number of the item's n-grams, whatever the edits: with two words, some
are always left. Half of those sure to be left may be spared, so each item's most common n-grams are no seeds, and
the rest are. Documents are then scanned again; where as many seeds of an item as any copy must hold fall close
together, the passage around them is aligned with the item word by word, and the best local alignment is scored
against a perfect copy. So every passage that reaches the least score is aligned. Both scans stay in the partitions
of the documents: no text is shuffled.

Words are runs of letters, digits and non-ASCII characters, without regard to the case of any script. Defined
results: null and empty texts and items match nothing. An item shorter than the n-gram is its own single seed and
needs a perfect copy. Repeated documents each match; repeated item rows match once per distinct text, under the
smallest id of that text. Different texts may share an id or have none: each matches in a row of its own. Extra
columns are not read. Without items or documents the result is empty.

The benchmark is handed to the tasks in slices of bounded size, one scan for each, so it can be of any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedgate.llm.batches import bounded_batches
from feedgate.llm.words import Words, words
from feedgate.plans.workspace import Workspace

# Of longer n-grams, copies with a word put in at every other place hold none.
NGRAM = 2
LEAST_SCORE = 0.6
MATCH, MISMATCH, GAP = 2, -1, -1
# Items of fewer words need a perfect copy: a few words recur by chance.
SHORT_ITEM = 8
SLICE_BYTES = 16 << 20
# Seed hits of a chunk are matched with items by so many at a time, or one document.
HITS = 1 << 20


def losses(length: int, least: float) -> int:
    """Points that a copy of an item of ``length`` words may lose and still be reported."""
    return 0 if length < SHORT_ITEM else math.floor(MATCH * length * (1 - least) + 1e-9)


def surely_left(length: int, n: int, least: float) -> int:
    """How many n-grams of the item every such copy still holds; for n above 2 one is assumed where none is sure.

    A word changed or left out breaks n of them, a word put in n - 1, a word cut off at an end one.
    """
    each = max(n / (MATCH - MISMATCH), n / (MATCH - GAP), (n - 1) / -GAP, 1 / MATCH)
    return max(1, length - n + 1 - math.floor(losses(length, least) * each))


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman with linear gaps: the best score and the passage position where it ends.

    Gaps along the passage are a running maximum, so each row of the table is a few vector operations.
    """
    steps = np.arange(len(passage) + 1) * -GAP
    row, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for word in item:
        new = np.maximum(row + GAP, 0)
        new[1:] = np.maximum(new[1:], row[:-1] + np.where(passage == word, MATCH, MISMATCH))
        row = np.maximum.accumulate(new + steps) - steps
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
    return best, end


def _plain_grams(n: int, least: float):
    """Every n-gram of an item: its number, hash and place, and how many of the item's may be spared as seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, chunk in words(batch.column(1), punctuation=True, folded=True):
                hashes, doc, first = chunk.shingles(n)
                spared = np.array([surely_left(x, n, least) // 2 for x in chunk.counts.tolist()], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(doc + at)),
                        pa.array(hashes.astype(np.int64)),
                        pa.array((first - chunk.bounds[doc]).astype(np.int32)),
                        pa.array(spared[doc]),
                    ],
                    ["number", "gram", "place", "spared"],
                )

    return run


def _runs(chunk: Words, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingles of all the sizes: that of the n-grams, and those of items with fewer words."""
    parts = [chunk.shingles(n) for n in sizes]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _frequencies(grams: np.ndarray, sizes: list[int]):
    """In how many documents each n-gram of the benchmark occurs, as partial counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(grams), np.int64)
        for batch in batches:
            for _, chunk in words(batch.column(0), punctuation=True, folded=True):
                hashes, doc, _ = _runs(chunk, sizes)
                at = _found(grams, hashes)
                hit = np.flatnonzero(at >= 0)
                once = np.unique(doc[hit] * len(grams) + at[hit]) % max(1, len(grams))
                total += np.bincount(once, minlength=len(grams))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(grams[some].astype(np.int64)), pa.array(total[some])], ["gram", "documents"]
        )

    return run


def _found(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Index of each value in the sorted values, or -1."""
    if not len(sorted_values):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return np.where(sorted_values[at] == values, at, -1)


def _passages(first: np.ndarray, last: np.ndarray, reach: int, words_left: int) -> list[tuple[int, int]]:
    """Where copies of up to ``reach`` words could lie that hold seeds from ``first`` to ``last``, in rising order."""
    merged: list[tuple[int, int]] = []
    for start, end in zip(np.maximum(last + 1 - reach, 0), np.minimum(first + reach, words_left), strict=True):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], int(end)))
        else:
            merged.append((int(start), int(end)))
    return merged


def _scan(seeds: dict, sizes: list[int], n: int, least: float):
    """Matches of one slice: ``seeds`` holds sorted gram and item index arrays, and the items' ids and words."""
    grams, items, ids, texts = (seeds[k] for k in ("gram", "item", "id", "words"))
    lengths = [len(x) for x in texts]
    reach = np.array([x + losses(x, least) for x in lengths], np.int64)
    left = [surely_left(x, n, least) for x in lengths]
    need = np.array([x - x // 2 for x in left], np.int64)

    def matches(chunk, doc: np.ndarray, place: np.ndarray, low: np.ndarray, size: np.ndarray) -> Iterator[tuple]:
        """Matches of some documents, given the places of seeds and their range in the table of seeds."""
        which = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        width = int(place.max()) + 1
        at, times = np.unique(
            (np.repeat(doc, size) * len(texts) + items[which]) * width + np.repeat(place, size), return_counts=True
        )
        pair, place = at // width, at % width
        item = pair % len(texts)
        # Where enough seeds for a copy begin, and where the last of them is.
        end = np.arange(len(at)) + need[item] - 1
        inside = np.minimum(end, len(at) - 1)
        near = (end < len(at)) & (pair[inside] == pair) & (place[inside] - place < reach[item])
        for one in np.split(np.flatnonzero(near), np.flatnonzero(np.diff(pair[near])) + 1) if near.any() else []:
            d, i = divmod(int(pair[one[0]]), len(texts))
            own = chunk.hashes[chunk.bounds[d] : chunk.bounds[d + 1]]
            asked = 1.0 if lengths[i] < SHORT_ITEM else least
            best = (0.0, 0)
            for a, b in _passages(place[one], place[inside[one]], int(reach[i]), len(own)):
                # Words in common bound the score from above.
                if np.isin(texts[i], own[a:b]).sum() < asked * lengths[i] - 1e-9:
                    continue
                score, last = align(texts[i], own[a:b])
                best = max(best, (score / (MATCH * lengths[i]), a + last))
            if best[0] >= asked:
                group = slice(*np.searchsorted(pair, [pair[one[0]], pair[one[0]] + 1]))
                yield d, ids[i], best[0], best[1], int(times[group].sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            for at, chunk in words(batch.column(1), punctuation=True, folded=True):
                hashes, doc, first = _runs(chunk, sizes)
                hit = np.flatnonzero(_found(grams, hashes) >= 0)
                hit = hit[np.argsort(doc[hit], kind="stable")]
                low = np.searchsorted(grams, hashes[hit], "left")
                size = np.searchsorted(grams, hashes[hit], "right") - low
                done = np.cumsum(size)
                begin = 0
                while begin < len(hit):
                    # Whole documents, as many as stay below HITS, but one at least.
                    end = int(np.searchsorted(done, done[begin] - size[begin] + HITS, "right"))
                    borders = np.searchsorted(doc[hit], [doc[hit[min(end, len(hit) - 1)]], doc[hit[begin]] + 1])
                    end = len(hit) if end == len(hit) else int(max(borders))
                    part = hit[begin:end]
                    own = first[part] - chunk.bounds[doc[part]]
                    for d, *found in matches(chunk, doc[part], own, low[begin:end], size[begin:end]):
                        rows.append(at + d)
                        out.append(found)
                    begin = end
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.float64()),
                    pa.array(columns[2], pa.int32()),
                    pa.array(columns[3], pa.int32()),
                ],
                ["doc_id", "item_id", "score", "end_word", "seed_hits"],
            )

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, ngram: int = NGRAM, least: float = LEAST_SCORE) -> DataFrame:
    """``doc_id, item_id, score, end_word, seed_hits`` of every document of ``docs`` that holds a copy of an item.

    ``score`` is the alignment's score over that of a perfect copy; ``end_word`` is where it ends.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    keep = Workspace(spark, "decontaminate").keep
    text = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = text.schema["doc_id"].dataType.simpleString()
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.where("text is not null").groupBy("text").agg(F.min("item_id").alias("item_id"))
    # Ids may repeat or be null; a distinct text has a number of its own, fixed by writing it.
    items = keep("items", items.select(F.monotonically_increasing_id().alias("number"), "text", "item_id"))
    schema = f"doc_id {kind}, item_id long, score double, end_word int, seed_hits int"
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = 1 + size // SLICE_BYTES
    found = [
        _slice(spark, keep, text, items.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == i), ngram, least, schema, i)
        for i in range(slices)
    ]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _slice(spark, keep, text: DataFrame, items: DataFrame, n: int, least: float, schema: str, turn: int) -> DataFrame:
    rows = items.collect()
    chunks = [c for _, c in words(pa.array([r.text for r in rows], pa.string()), punctuation=True, folded=True)]
    texts = [c.hashes[a:b] for c in chunks for a, b in zip(c.bounds[:-1], c.bounds[1:], strict=True)]
    sizes = sorted({n} | {len(x) for x in texts if 0 < len(x) < n})
    grams = keep(f"grams{turn}", items.mapInArrow(_plain_grams(n, least), "number long, gram long, place int, spared int"))
    known = np.unique(np.array([r.gram for r in grams.select("gram").distinct().collect()], np.int64).astype(np.uint64))
    counted = text.select("text").mapInArrow(_frequencies(known, sizes), "gram long, documents long")
    counted = counted.groupBy("gram").agg(F.sum("documents").alias("documents"))
    # N-grams no document holds are not in ``counted``: they seed nothing.
    ranked = grams.join(counted, "gram").select(
        "number",
        "gram",
        F.expr("row_number() over (partition by number order by documents desc, place desc) <= spared").alias("common"),
    )
    seeds = ranked.where("not common").collect()
    index = {r.number: i for i, r in enumerate(rows)}
    unsigned = np.array([s.gram for s in seeds], np.int64).astype(np.uint64)
    order = np.argsort(unsigned, kind="stable")
    table = {
        "gram": unsigned[order],
        "item": np.array([index[s.number] for s in seeds], np.int64)[order],
        "id": [r.item_id for r in rows],
        "words": texts,
    }
    return text.mapInArrow(_scan(table, sizes, n, least), schema)
