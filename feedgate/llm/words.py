"""Words and word shingles of Arrow text columns as 64-bit hashes, computed with numpy over whole batches.

Words are maximal runs of bytes other than space and tab to carriage return, after lower-casing A-Z; with
``punctuation``, every ASCII byte that is neither letter nor digit also ends a word. In UTF-8 these bytes never
occur inside another character, so the byte view is exact. With ``folded``, letters of all scripts are compared
without regard to case.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19

_GOLDEN = 0x9E3779B97F4A7C15
_BASE = 0x5851F42D4C957F2D
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser on uint64 values."""
    x = x + np.uint64(_GOLDEN)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    def table(base: int) -> np.ndarray:
        out = np.full(1 << bits, base, np.uint64)
        out[0] = 1
        return np.cumprod(out)

    return table(_BASE), table(pow(_BASE, -1, 1 << 64))


def odd_constants(n: int, seed: int = 0) -> np.ndarray:
    return mix(np.arange(1 + seed, n + 1 + seed, dtype=np.uint64)) | np.uint64(1)


SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
PUNCTUATION = np.arange(256) < 128
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    powers, inverse = _powers(max(20, int(len(data)).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


class Words:
    """The words of some consecutive documents: hashes, and where each document's words begin.

    ``stems``, if asked for, are the hashes of the words' first bytes.
    """

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray, stems: np.ndarray | None = None):
        self.hashes, self.bounds, self.stems = hashes, bounds, stems

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.counts)

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, document and first word of every run of n words; a shorter document is one run."""
        doc, counts = self.doc, self.counts
        left = self.bounds[1:][doc] - np.arange(len(doc))
        first = np.flatnonzero(left >= n)
        factors = odd_constants(n)
        total = np.full(len(first), n, np.uint64)
        for i in range(n):
            total += self.hashes[first + i] * factors[i]
        short = np.flatnonzero((counts > 0) & (counts < n))
        if len(short):
            sums = counts[short].astype(np.uint64)
            for i in range(n - 1):
                has = counts[short] > i
                sums[has] += self.hashes[self.bounds[short[has]] + i] * factors[i]
            first = np.concatenate([first, self.bounds[short]])
            total = np.concatenate([total, sums])
        return mix(total), doc[first], first


def _plain(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def _words_of(data: np.ndarray, bounds: np.ndarray, gap: np.ndarray, stem: int) -> Words:
    """``bounds``: where each document begins in data, and the end."""
    word = ~gap[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], word[:-1]]) if len(data) else word
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.concatenate([word[1:], [False]]) if len(data) else word
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    plain = _plain(data)
    stems = _hash_spans(plain, starts, np.minimum(ends, starts + stem)) if stem else None
    return Words(_hash_spans(plain, starts, ends), np.searchsorted(starts, bounds), stems)


def _long(data: np.ndarray, space: np.ndarray, stem: int) -> Words:
    """One long document, cut at white space so that memory stays bounded by the longest word."""
    parts, at = [], 0
    while at < len(data):
        end = min(len(data), at + CHUNK_BYTES)
        step = CHUNK_BYTES
        while end < len(data) and not (gaps := np.flatnonzero(space[data[end : end + step]])).size:
            end = min(len(data), end + step)
        end = end + int(gaps[0]) if end < len(data) else len(data)
        parts.append(_words_of(data[at:end], np.array([0, end - at]), space, stem))
        at = end
    hashes = np.concatenate([p.hashes for p in parts])
    stems = np.concatenate([p.stems for p in parts]) if stem else None
    return Words(hashes, np.array([0, len(hashes)]), stems)


def _folded(texts: pa.Array) -> pa.Array:
    """Unicode case folding of texts, so a sharp s and its capitals or a final sigma match; bytes that are no UTF-8 stay."""
    raw = texts.cast(pa.large_binary()).to_pylist()
    raw = [x.decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape") for x in raw]
    return pa.array(raw, pa.large_binary()).view(pa.large_string())


def words(texts: pa.Array, punctuation: bool = False, stem: int = 0, folded: bool = False) -> Iterator[tuple[int, Words]]:
    """Index of the first document and the words of some documents, chunk by chunk. Null text: no words."""
    if not len(texts):
        return
    gap = PUNCTUATION if punctuation else SPACE
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        part = data[offsets[at] : offsets[end]]
        if folded:
            for i, chunk in words(_folded(texts.slice(at, end - at)), punctuation, stem):
                yield at + i, chunk
        elif len(part) > CHUNK_BYTES:
            yield at, _long(part, gap, stem)
        else:
            yield at, _words_of(part, offsets[at : end + 1] - offsets[at], gap, stem)
        at = end


def sets(words: Words, n: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each document."""
    hashes, doc, _ = words.shingles(n)
    order = np.argsort(doc, kind="stable")
    bounds = np.searchsorted(doc[order], np.arange(len(words) + 1))
    hashes = hashes[order]
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
