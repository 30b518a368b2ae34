"""Operator 4: secret scan with structural confirmation.

Three base kinds are plain patterns. Beyond them, runs of base64 or hex characters, PEM blocks and dotted
tokens are only candidates: they are decoded, and reported when the decoded bytes are a private key (DER
with nested lengths that fill it exactly, or an OpenSSH key with its length-prefixed fields) or when the
header of a signed token is a JSON object that names an algorithm. Base64 wrapped over lines is joined first, as far as
the key itself says it reaches. PEM blocks may have their line ends escaped, their lines quoted and joined as in
source code, and the header lines of the older encrypted form.

Defined results: null or empty text has no spans. Rows are scanned one by one, so repeated rows repeat
their result, and other columns are not read. Texts are scanned whole. Positions are code points. An empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedgate.llm.batches import bounded_batches

# The order of kinds at the same start, and the base patterns.
KINDS = ("assign", "access", "hex", "pem", "key64", "keyhex", "token")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
WORDS_OF_ASSIGN = ("password", "passwd", "secret", "token", "apikey", "api_key")

PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----([^-]*(?:-(?!----)[^-]*)*)-----END \1-----")
# How the lines of a PEM block are written inside other text: escaped ends, quotes, commas, joined by a plus or a backslash.
ESCAPED_END = re.compile(r"\\+[rnt]")
JOINED = re.compile(r"""["']\s*[+.,;\\]?\s*["']|["',;\\]""")
# The header lines of an encrypted key in the older form.
ENCRYPTED = re.compile(r"\s*Proc-Type:\s*4\s*,\s*ENCRYPTED\s+DEK-Info:\s*[A-Z0-9-]+\s*,\s*((?:[0-9A-Fa-f]{16}){1,2})\s+")
BASE64_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_RUN = re.compile(r"(?<![0-9A-Fa-f])(?:[0-9A-Fa-f]{2}){32,}(?![0-9A-Fa-f])")
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
# A brace, with white space before it or after it, in base64.
TOKEN = re.compile(
    r"(?<![A-Za-z0-9_-])((?:e[yw]|I[ACH]|C[QSXgin]|D[QSX])[A-Za-z0-9_-]+)(?=\.([A-Za-z0-9_-]*)\.([A-Za-z0-9_-]*))"
)
OPENSSH = b"openssh-key-v1\0"

_RUN = np.zeros(256, bool)
_RUN[np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-", np.uint8)] = True
LONG_RUN = 20


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value at ``at``; None if the length does not fit."""
    if at + 2 > end:
        return None
    tag, length, at = data[at], data[at + 1], at + 2
    if length & 0x80:
        size = length & 0x7F
        if not 1 <= size <= 4 or at + size > end:
            return None
        length, at = int.from_bytes(data[at : at + size], "big"), at + size
    return (tag, at, at + length) if at + length <= end else None


def _children(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    found = []
    while at < end:
        item = _tlv(data, at, end)
        if item is None:
            return None
        found.append(item)
        at = item[2]
    return found


def der_key(data: bytes) -> bool:
    """A DER sequence that fills the data and starts like a private key: version, then numbers or algorithm, or encrypted."""
    outer = _tlv(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    parts = _children(data, outer[1], outer[2])
    if parts and [x[0] for x in parts] == [0x30, 0x04]:  # encrypted: algorithm with its parameters, then the wrapped key
        names = _children(data, parts[0][1], parts[0][2])
        return bool(names) and [x[0] for x in names] == [0x06, 0x30] and parts[1][2] - parts[1][1] >= 16
    if not parts or len(parts) < 2 or parts[0][0] != 0x02 or parts[0][2] - parts[0][1] != 1:
        return False
    tags = [x[0] for x in parts]
    if tags[1:9] == [0x02] * 8 or tags[1:6] == [0x02] * 5:
        return True
    if tags[1] == 0x04:  # elliptic curve key: the number, then its curve or point
        return parts[1][2] - parts[1][1] >= 16 and all(x in (0xA0, 0xA1) for x in tags[2:])
    if tags[1] == 0x30 and len(tags) > 2 and tags[2] == 0x04:  # algorithm, then the wrapped key
        names = _children(data, parts[1][1], parts[1][2])
        return bool(names) and names[0][0] == 0x06
    return False


def openssh_key(data: bytes) -> bool:
    """Cipher, derivation and options as length-prefixed fields, then at least one public key."""
    if not data.startswith(OPENSSH):
        return False
    at = len(OPENSSH)
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at + 8 <= len(data) and int.from_bytes(data[at : at + 4], "big") >= 1


def _decoded(text: str) -> bytes | None:
    text = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _is_key(data: bytes | None) -> bool:
    return data is not None and (der_key(data) or openssh_key(data))


def signed_token(header: str) -> bool:
    """The payload may be detached, compressed or plain text, so the header alone decides."""
    try:
        value = json.loads(_decoded(header) or b"")
    except (ValueError, RecursionError):
        return False
    return isinstance(value, dict) and isinstance(value.get("alg"), str)


def _tokens(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in TOKEN.finditer(text):
        if m.start() >= done and (m[2] or m[3]) and signed_token(m[1]):
            done = m.end(3)
            yield m.start(), done


def pem_key(body: str) -> bool:
    """Whether what stands between the lines of a PEM block is a key."""
    plain = ESCAPED_END.sub("\n", body)
    sealed = ENCRYPTED.match(JOINED.sub(lambda m: "," if m[0] == "," else " ", plain))
    if sealed:
        # The blocks of the cipher are as long as its start value.
        data = _decoded(JOINED.sub("", plain.split(sealed[1], 1)[1]))
        return bool(data) and len(data) % (len(sealed[1]) // 2) == 0
    return _is_key(_decoded(JOINED.sub("", plain)))


def _openssh_size(data: bytes, most: int) -> tuple[int, bool]:
    """Bytes of the key at the start of the data (three fields, the public keys, the private part), and whether they are known.

    Without enough data the number is how many bytes must be looked at; beyond ``most`` there is no such key.
    """
    at, fields, counted = len(OPENSSH), 3, False
    while at <= most:
        if at + 4 > len(data):
            return max(at + 4, len(data) + 1), False
        value = int.from_bytes(data[at : at + 4], "big")
        if fields:
            at, fields = at + 4 + value, fields - 1
        elif counted:
            break
        else:
            at, fields, counted = at + 4, value + 1, True
        if counted and not fields:
            return at, True
    return most + 1, True


class _Lines:
    """The lines of a stretch of wrapped base64, and how many characters stand before each."""

    def __init__(self, text: str, start: int, end: int):
        self.lines = list(LINE.finditer(text, start, end))
        self.before = [0, *accumulate(len(x[0].rstrip("=")) for x in self.lines)]

    def bytes_from(self, at: int, size: int) -> bytes:
        """At least ``size`` bytes from a line on, or all there are."""
        end = bisect_left(self.before, self.before[at] - (-size * 4 // 3) + 4, at + 1)
        whole = "".join(x[0].rstrip("=") for x in self.lines[at:end])
        return _decoded(whole[: len(whole) // 4 * 4]) or b""

    def key_end(self, at: int) -> int:
        """The line behind the key that begins with a line, or 0: it ends where a line ends."""
        text, rest = self.lines[at][0], (self.before[-1] - self.before[at]) * 3 // 4
        if text.startswith("b3BlbnNzaC1rZXktdjE"):
            total, known = 256, False
            while not known:
                data = self.bytes_from(at, 2 * total)
                total, known = _openssh_size(data, rest)
                if not known and total > rest:
                    return 0
        else:
            head = _decoded(text[:8]) if text.startswith("M") else None
            size = head[1] & 0x7F if head and head[1] & 0x80 else 0
            if not head or head[0] != 0x30 or size > 4:
                return 0
            total = 2 + size + (int.from_bytes(head[2 : 2 + size], "big") if size else head[1])
        if total > rest:
            return 0
        stop = self.before[at] - (-total * 4 // 3)
        end = bisect_left(self.before, stop, at + 1)
        return end if end < len(self.before) and self.before[end] == stop else 0


def _wrapped(text: str) -> Iterator[tuple[int, int]]:
    """Keys in base64 over several lines."""
    for m in WRAPPED.finditer(text):
        found = _Lines(text, m.start(), m.end())
        lines, at = found.lines, 0
        while at < len(lines):
            end = found.key_end(at)
            if end > at + 1 and _is_key(_decoded("".join(x[0] for x in lines[at:end]))):
                yield lines[at].start(), lines[end - 1].end()
                at = end
            else:
                at += 1


def spans(text: str, runs: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end), sorted. ``runs``: the text has a long run of key characters."""
    found = []
    low = text.lower()
    if any(w in low for w in WORDS_OF_ASSIGN):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "-----BEGIN " in text:
        found += [(m.start(), 3, m.end()) for m in PEM.finditer(text) if pem_key(m[2])]
    if runs:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        found += [(m.start(), 4, m.end()) for m in BASE64_RUN.finditer(text) if _is_key(_decoded(m[0]))]
        found += [(m.start(), 5, m.end()) for m in HEX_RUN.finditer(text) if _is_key(bytes.fromhex(m[0]))]
        armoured = [(a, b) for a, k, b in found if k == 3]
        for a, b in _wrapped(text):
            if not any(x <= a and b <= y for x, y in armoured):
                found = [x for x in found if x[1] != 4 or x[2] <= a or x[0] >= b] + [(a, 4, b)]
    if "." in text:
        found += [(a, 6, b) for a, b in _tokens(text)]
    return sorted(found)


def _long_runs(texts: pa.Array) -> np.ndarray:
    """Which texts have a run of at least LONG_RUN key characters."""
    out = np.zeros(len(texts), bool)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    at, step = 0, 1 << 22
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + step, "right")) - 1)
        part = data[offsets[at] : offsets[end]]
        other = np.concatenate([[-1], np.flatnonzero(~_RUN[part]), [len(part)]])
        starts = other[:-1][np.diff(other) > LONG_RUN] + offsets[at] + 1
        # A run over the border of two texts only costs a scan of the first; look at the next one too.
        hit = np.searchsorted(offsets, starts, "right") - 1
        ends = np.searchsorted(offsets, other[1:][np.diff(other) > LONG_RUN] + offsets[at], "left")
        for a, b in zip(hit, ends, strict=True):
            out[a:b] = True
        at = end
    return out


SCHEMA = "doc_id {kind}, spans array<struct<kind: string, start: int, end: int>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
        runs = _long_runs(texts)
        found = [
            [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans(text.as_py(), runs[i])]
            for i, text in enumerate(texts)
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])


def secret_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` (kind, start, end) for every row of ``docs(doc_id, text)``."""
    bounded_batches(docs.sparkSession)
    text = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return text.mapInArrow(_scan, SCHEMA.format(kind=text.schema["doc_id"].dataType.simpleString()))


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as text."""

    def written(of: str):
        return F.expr(f"array_join(transform({of}, x -> concat_ws(':', x.kind, x.start, x.end)), ',')")

    base = "filter(spans, x -> x.kind in ('assign', 'access', 'hex'))"
    counts = [F.expr(f"cast(size(filter(spans, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written("spans").alias("spans"))
