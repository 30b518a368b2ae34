"""Operator 6: toxic passages as maximum-scoring segments, calibrated by extreme-value statistics.

Every word scores the log-odds of toxic against other documents. The counts are smoothed by two Dirichlet priors:
a word's by its stem (its first bytes), a stem's by the whole sample, so an unseen inflection takes its stem's
odds. Two standard deviations are taken off and a constant per word, so ordinary text drifts down. A linear scan
finds all maximal segments of a document (Ruzzo and Tompa). Under the words' frequencies in other documents
the best segment follows an extreme-value law (Karlin and Altschul); its expected number of chance segments
becomes the evidence of the document, which a logistic curve turns into a score.

A document is judged by words that count once, where they first occur, so that one repeated word is no evidence of its
own. Passages are searched with every occurrence counted, under a chance law of their own: a passage that comes
again in the same words is found again.

Learning uses labelled rows of training folds only: at most ``FIT_ROWS`` of them, by hash of the id, so that the
sample that is broadcast and the two tables of odds have a fixed size. Counts come from three folds, the
calibration from the fourth.

Defined results: null and empty texts have no segment and the score of no evidence. Labels that are null or
neither 0 nor 1, or whose ``doc_id`` is null, are ignored; a document labelled both ways counts for both. Without labels of
both kinds every score is that of a document without evidence. Repeated rows repeat their result. Extra
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedgate.llm.batches import bounded_batches
from feedgate.llm.words import Words, words

FIT_ROWS = 40_000
FOLDS = 5
CALIBRATION_FOLD = 4
WORD_BITS = 20
STEM_BITS = 18
STEM_BYTES = 5
STEM_PRIOR = 20.0
WORD_PRIOR = 5.0
DEVIATIONS = 2.0
DRIFT = 0.15
SIGNIFICANT = 0.01
LEAST_CALIBRATION = 5


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; fold 0 is held out."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


@dataclass
class Model:
    """Scores of hashed words, or of the stem where the word was never counted; the chance laws; the curve."""

    word: np.ndarray
    stem: np.ndarray
    rate: float
    scale: float
    slope: float
    offset: float
    passage_rate: float = 1.0
    passage_scale: float = 1.0

    def scores(self, chunk: Words) -> tuple[np.ndarray, np.ndarray]:
        """Scores to judge documents by and scores to search passages with.

        For documents a word counts where it first occurs, as in the counts, and repeats only drift down; for passages
        every occurrence counts.
        """
        slot = (chunk.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
        own = self.word[slot]
        of_stem = self.stem[(chunk.stems >> np.uint64(64 - STEM_BITS)).astype(np.int64)]
        value = np.where(np.isnan(own), of_stem, own)
        first = np.zeros(len(slot), bool)
        first[np.unique(chunk.doc << WORD_BITS | slot, return_index=True)[1]] = True
        return np.where(first, value, np.minimum(value, 0)) - DRIFT, value - DRIFT

    def evidence(self, best: float, n: int) -> float:
        """Minus the log of the number of segments this good that chance would bring."""
        return self.rate * best - math.log(self.scale * max(n, 1)) if best > 0 else -math.log(self.scale * max(n, 1) + 1)

    def chance(self, score: float, n: int) -> float:
        """How likely n words of an untoxic document hold a passage this good."""
        return -math.expm1(-math.exp(min(500.0, math.log(self.passage_scale * max(n, 1)) - self.passage_rate * score)))

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.offset + self.slope * evidence))))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, end, score), in one pass over runs of equal sign."""
    positive = scores > 0
    if not positive.any():
        return []
    edges = np.flatnonzero(np.diff(positive)) + 1
    starts = np.concatenate([[0], edges])
    ends = np.concatenate([edges, [len(scores)]])
    sums = np.add.reduceat(scores, starts)
    found: list[list[float]] = []  # first, end, total before, total after
    total = 0.0
    for a, b, s in zip(starts.tolist(), ends.tolist(), sums.tolist(), strict=True):
        before, total = total, total + s
        if s <= 0:
            continue
        new = [a, b, before, total]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j -= 1
            if j < 0 or found[j][3] >= new[3]:
                found.append(new)
                break
            new = [found[j][0], b, found[j][2], total]
            del found[j:]
    return [(int(a), int(b), y - x) for a, b, x, y in found]


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per hashed word and stem, by label, summed over the partition."""
    sizes = (1 << WORD_BITS, 1 << STEM_BITS)
    counts = [np.zeros((2, s), np.int64) for s in sizes]
    docs = np.zeros(2, np.int64)
    for batch in batches:
        toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        docs += np.bincount(toxic, minlength=2)[:2]
        for at, chunk in words(batch.column(0), punctuation=True, stem=STEM_BYTES):
            doc = chunk.doc
            for hashes, bits, count in zip((chunk.hashes, chunk.stems), (WORD_BITS, STEM_BITS), counts, strict=True):
                slot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
                once = np.unique(doc << bits | slot)
                label = toxic[at + (once >> bits)]
                np.add.at(count, (label, once & ((1 << bits) - 1)), 1)
    for kind, count in enumerate(counts):
        some = np.flatnonzero(count.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(some), kind, np.int32)), pa.array(some), pa.array(count[0, some]), pa.array(count[1, some])],
            ["kind", "slot", "clean", "toxic"],
        )
    yield pa.RecordBatch.from_arrays(
        [pa.array([2], pa.int32()), pa.array([0], pa.int64()), pa.array(docs[:1]), pa.array(docs[1:])],
        ["kind", "slot", "clean", "toxic"],
    )


def _logit(x: np.ndarray) -> np.ndarray:
    return np.log(x / (1 - x))


def odds(counts: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray] | None:
    """Scores of words (NaN: not seen) and of stems from (slot, clean, toxic) counts."""
    clean, toxic = counts[2][0, 1:] if len(counts[2]) else (0, 0)
    if not clean or not toxic:
        return None
    prior = toxic / (clean + toxic)

    def table(bits: int, rows: np.ndarray, base: np.ndarray | float, weight: float) -> np.ndarray:
        c, t = np.zeros(1 << bits), np.zeros(1 << bits)
        c[rows[:, 0]], t[rows[:, 0]] = rows[:, 1], rows[:, 2]
        share = (t + weight * base) / (t + c + weight)
        spread = np.sqrt(1 / (t + weight * prior) + 1 / (c + weight * (1 - prior)))
        value = _logit(np.clip(share, 1e-6, 1 - 1e-6)) - _logit(np.array(prior))
        value = np.sign(value) * np.maximum(np.abs(value) - DEVIATIONS * spread, 0)
        value[(c + t) == 0] = np.nan
        return value

    stems = table(STEM_BITS, counts[1], prior, STEM_PRIOR)
    return table(WORD_BITS, counts[0], prior, WORD_PRIOR), np.nan_to_num(stems, nan=0.0)


def _best(scores: np.ndarray) -> float:
    return max((s for *_, s in segments(scores)), default=0.0)


def _scores(model: Model, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Both kinds of scores, document by document."""
    for _, chunk in words(texts, punctuation=True, stem=STEM_BYTES):
        once, every = model.scores(chunk)
        for a, b in zip(chunk.bounds[:-1], chunk.bounds[1:], strict=True):
            yield once[a:b], every[a:b]


def _histogram(scores: np.ndarray) -> dict[str, list[int]]:
    """How often each score occurs, in tenths from -20 to 20."""
    times = np.bincount(np.clip(np.round(scores * 10) + 200, 0, 400).astype(int), minlength=401)
    some = np.flatnonzero(times)
    return {"at": some.tolist(), "times": times[some].tolist()}


HISTOGRAM = "struct<at: array<int>, times: array<int>>"
CALIBRATED = f"toxic int, n long, best double, scores {HISTOGRAM}, passage_best double, passage_scores {HISTOGRAM}"


def _calibration(handle):
    """Length and label of calibration documents; of both kinds of scores the best segment and how often each occurs."""
    histogram = pa.struct([("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])
    doubles = pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = handle.value
        for batch in batches:
            both = list(zip(*_scores(model, batch.column(0)), strict=True)) or [(), ()]
            columns = [batch.column(1).cast(pa.int32()), pa.array([len(own) for own in both[0]], pa.int64())]
            for kind in both:
                columns += [pa.array([_best(own) for own in kind], doubles), pa.array([_histogram(own) for own in kind], histogram)]
            names = ["toxic", "n", "best", "scores", "passage_best", "passage_scores"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def chance_rate(values: np.ndarray, times: np.ndarray) -> float:
    """Karlin and Altschul's lambda: the positive root of the scores' mean of exp(lambda * score) = 1."""
    share = times / max(times.sum(), 1)
    if not (values[times > 0] > 0).any() or (share * values).sum() >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    with np.errstate(over="ignore"):
        while (share * np.exp(high * values)).sum() < 1 and high < 100:
            high *= 2
        for _ in range(60):
            middle = (low + high) / 2
            if (share * np.exp(middle * values)).sum() < 1:
                low = middle
            else:
                high = middle
    return (low + high) / 2


def chance_law(clean: pd.DataFrame, best: str, scores: str) -> tuple[float, float]:
    """Rate and scale of the extreme-value law that the best segments of untoxic documents follow."""
    times = np.zeros(401, np.int64)
    for found in clean[scores]:
        times[np.asarray(found["at"], np.int64)] += np.asarray(found["times"], np.int64)
    rate = chance_rate((np.arange(401) - 200) / 10, times)
    # Gumbel: the median of rate * best - log(n) over chance documents is log(scale) minus log(log(2)).
    centred = rate * clean[best].to_numpy() - np.log(clean["n"].to_numpy())
    return rate, float(np.exp(np.median(centred) + math.log(math.log(2))))


def curve(evidence: np.ndarray, label: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a small ridge."""
    centre, width = evidence.mean(), max(evidence.std(), 1e-9)
    x = np.stack([(evidence - centre) / width, np.ones(len(evidence))], axis=1)
    beta, ridge = np.zeros(2), np.array([0.01, 0.001])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weights * (label - p)) - ridge * beta
        bend = (x * (weights * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + np.diag(ridge)
        beta = beta + np.linalg.solve(bend, slope)
    return beta[0] / width, beta[1] - beta[0] * centre / width


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """The model from labelled rows outside fold 0.

    What reaches the driver is bounded: counts of 2**WORD_BITS words and 2**STEM_BITS stems, and one short row
    for each sampled calibration document.
    """
    spark = docs.sparkSession
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).withColumn("fold", fold(F.col("doc_id")))
    sample = known.where("fold <> 0").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(fit_rows)
    # At most fit_rows short rows.
    text = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    labelled = text.join(F.broadcast(sample), "doc_id").select("text", "toxic", "fold")
    counted = labelled.where(f"fold <> {CALIBRATION_FOLD}").select("text", "toxic")
    counted = counted.mapInArrow(_presence, "kind int, slot long, clean long, toxic long")
    counted = counted.groupBy("kind", "slot").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    table = counted.toArrow()
    kinds = table["kind"].to_numpy()
    rows = np.stack([table[c].to_numpy() for c in ("slot", "clean", "toxic")], axis=1).reshape(-1, 3)
    found = odds({k: rows[kinds == k] for k in range(3)})
    if found is None:
        blank = np.zeros(1 << WORD_BITS, np.float32)
        return Model(blank, np.zeros(1 << STEM_BITS, np.float32), 1.0, 1.0, 1.0, -4.0)
    model = Model(found[0].astype(np.float32), found[1].astype(np.float32), 1.0, 1.0, 1.0, -4.0)
    handle = spark.sparkContext.broadcast(model)
    tested = labelled.where(f"fold = {CALIBRATION_FOLD}").select("text", "toxic")
    tested = tested.mapInArrow(_calibration(handle), CALIBRATED).toPandas()
    clean = tested[(tested["toxic"] == 0) & (tested["n"] > 0)]
    if len(clean) < LEAST_CALIBRATION or tested["toxic"].sum() < LEAST_CALIBRATION:
        return model
    model.rate, model.scale = chance_law(clean, "best", "scores")
    model.passage_rate, model.passage_scale = chance_law(clean, "passage_best", "passage_scores")
    evidence = np.array([model.evidence(b, n) for b, n in zip(tested["best"], tested["n"], strict=True)])
    label = tested["toxic"].to_numpy().astype(float)
    model.slope, model.offset = curve(evidence, label, np.ones(len(label)))
    return model


PASSAGES = "array<struct<first: int, end: int, score: double, chance: double>>"


def _score(handle):
    passage = pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("chance", pa.float64())])
    keys = ("first", "end", "score", "chance")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = handle.value
        for batch in batches:
            scores, passages = [], []
            for once, every in _scores(model, batch.column(1)):
                n = len(once)
                scores.append(model.score(model.evidence(_best(once), n)))
                found = ((first, end, s, model.chance(s, n)) for first, end, s in segments(every))
                passages.append([dict(zip(keys, p, strict=True)) for p in found if p[3] <= SIGNIFICANT])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(passages, pa.list_(passage))],
                ["doc_id", "score", "passages"],
            )

    return run


def _below(handle, column: int, limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = handle.value
        for batch in batches:
            texts = batch.column(column).cast(pa.large_string())
            kept = [model.score(model.evidence(_best(once), len(once))) < limit for once, _ in _scores(model, texts)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return run


def without_toxic(docs: DataFrame, labels: DataFrame, limit: float) -> DataFrame:
    """The rows of ``docs`` that score below the limit, whole, in one pass and without a join."""
    bounded_batches(docs.sparkSession)
    handle = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    return docs.mapInArrow(_below(handle, docs.columns.index("text"), limit), docs.schema)


def toxic_passages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, score, passages`` for every row: significant segments as word numbers, with score and chance."""
    bounded_batches(docs.sparkSession)
    handle = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    text = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = text.schema["doc_id"].dataType.simpleString()
    return text.mapInArrow(_score(handle), f"doc_id {kind}, score double, passages {PASSAGES}")


def digest(scored: DataFrame) -> DataFrame:
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("passages").alias("n_passages"),
    )
