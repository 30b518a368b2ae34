"""The operators on small inputs, against brute force, round trips and their defined edge cases."""

from __future__ import annotations

import base64
import collections
import hashlib
import itertools
import json
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedgate.llm import chat, decontaminate, mixing, near_dedup, neighbours, secrets, sharding, token_counts, toxicity, url_filter
from feedgate.llm.bpe import TOKENIZER, encoder
from feedgate.llm.components import components
from feedgate.llm.words import words
from feedgate.plans.workspace import Workspace

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """(id, text[, source]) with the other columns filled, and some whose names clash with results."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
    extra = ("node", "bucket", "kept", "shard", "copies", "root")
    return spark.createDataFrame(full, DOC).withColumns({c: F.lit("x") for c in extra})


def prose(rng, n):
    return " ".join(rng.choice([f"w{i}" for i in range(400)], n))


def shingles(text, n):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if len(found) < n:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1))


def brute_components(rows, n, percent):
    sets = {i: shingles(t, n) for i, t in rows}
    low = {i: i for i in sets}

    def top(i):
        while low[i] != i:
            i = low[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            one, two = sorted((top(a), top(b)))
            low[two] = one
    return {i: (len(sets[i]), top(i), top(i) == i) for i in sets}


@pytest.mark.parametrize(("n", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, n, percent):
    rng = np.random.default_rng(n)
    rows, base = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "oNE"), (5, "a b"), (6, "a  b")], []
    for _ in range(8):
        base.append(prose(rng, 80).split())
    for i in range(7, 160):
        own = list(base[i % 8])
        for _ in range(rng.integers(0, 4)):
            own[rng.integers(0, len(own))] = f"e{rng.integers(0, 9)}"
        rows.append((i, " ".join(own)))
    rows.append((160, " ".join(base[0]) * 40))
    found = near_dedup.near_duplicates(documents(spark, rows), n, percent).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute_components(rows, n, percent)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(7, "a b c d"), (7, "a b c d"), (None, "a b c d"), (3, "A B C D"), (None, None), (9, "other words are here")]
    found = sorted(map(tuple, near_dedup.near_duplicates(documents(spark, rows)).collect()), key=repr)
    assert found == sorted(
        [(7, 2, 3, False), (7, 2, 3, False), (None, 2, 3, False), (3, 2, 3, True), (None, 0, None, False), (9, 2, 9, True)],
        key=repr,
    )
    left = near_dedup.without_duplicates(documents(spark, [*rows, (9, rows[-1][1])]), 3, 85)
    assert sorted(repr(r.doc_id) for r in left.collect()) == ["3", "9", "None", "None"]
    assert near_dedup.near_duplicates(documents(spark, rows).limit(0)).count() == 0


def test_secrets_in_other_encodings():
    def b64(data):
        return base64.urlsafe_b64encode(data).decode().rstrip("=")

    def tlv(tag, data):
        size = bytes([len(data)]) if len(data) < 128 else b"\x82" + len(data).to_bytes(2, "big")
        return bytes([tag]) + size + data

    tokens = [
        b64(b'{"alg":"HS256"}') + ".." + "s" * 20,
        b64(b'{ "alg": "HS256"}') + "." + b64(b"plain text") + "." + "s" * 20,
        b64(b'\n{"alg":"HS256"}') + "." + b64(b"\x78\x9c\x01") + "." + "s" * 20,
    ]
    for token in tokens:
        assert secrets.spans(f"It.is {token}, so") == [(6, 6, 6 + len(token))]
    assert secrets.spans(b64(b'{"typ":"HS256"}') + ".e30.ssss") == [] == secrets.spans("Inc.It.Do.")
    sealed = tlv(0x30, tlv(0x30, tlv(0x06, b"\x2a\x86\x48") + tlv(0x30, b"\x02\x01\x01")) + tlv(0x04, bytes(range(200)) * 2))
    digest = tlv(0x30, tlv(0x30, tlv(0x06, b"\x2a\x86\x48") + tlv(0x05, b"")) + tlv(0x04, bytes(64)))
    assert secrets.der_key(sealed) and not secrets.der_key(digest)
    for width in (64, 76):
        lines = re.findall(f".{{1,{width}}}", base64.b64encode(sealed).decode())
        key = "\n".join(lines)
        assert secrets.spans(f"key {key}\nthen other words") == [(4, 4, 4 + len(key))]
        assert secrets.spans(f"{key[:-30]}\nthen other words") == []
    fields = [b"none", b"none", b"", b"public" * 9, b"private" * 30]
    fields = [len(x).to_bytes(4, "big") + x for x in fields]
    opened = secrets.OPENSSH + b"".join(fields[:3]) + (1).to_bytes(4, "big") + b"".join(fields[3:])
    key = "\n".join(re.findall(".{1,70}", base64.b64encode(opened).decode()))
    assert secrets.spans(f"key {key}\nthen other words") == [(4, 4, 4 + len(key))]


def test_duplicates_are_dropped_row_by_row(spark):
    rng = np.random.default_rng(14)
    copied, clean, twice = (prose(rng, 60) for _ in range(3))
    rows = [(1, copied), (5, copied), (5, clean), (7, clean + " "), (9, twice), (9, twice + " "), (9, ""), (9, None), (5, clean)]
    left = near_dedup.without_duplicates(documents(spark, rows), 3, 85).select("doc_id", "text").collect()
    assert sorted((r.doc_id, (r.text or "").strip()) for r in left) == sorted([(1, copied), (5, clean), (9, twice), (9, ""), (9, "")])


def test_large_bucket_in_several_components(spark):
    """A chain of copies in one bucket, none of them like the smallest: only the block comparison links it."""
    rng = np.random.default_rng(5)
    base = prose(rng, 300).split()
    rows = []
    for i in range(60):
        own = list(base)
        for j in range(i * 2, i * 2 + 6):
            own[j % 300] = f"x{i}_{j}"
        rows.append((i, " ".join(own)))
    found = near_dedup.near_duplicates(documents(spark, rows), 3, 90).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: v[1] for i, v in brute_components(rows, 3, 90).items()}


def test_components_of_a_long_path(spark):
    order = np.random.default_rng(1).permutation(200).tolist()
    links = [(a, b) for a, b in itertools.pairwise(order)] + [(500, 501), (501, 501)]
    found = components(spark.createDataFrame(links, "a long, b long"), Workspace(spark, "test").keep)
    assert {r.node: r.root for r in found.collect()} == {i: 0 for i in range(200)} | {500: 500, 501: 500}


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    shared, own = rng.integers(0, 2**63, 800).astype(np.uint64), rng.integers(0, 2**63, 400).astype(np.uint64)
    a, b = np.concatenate([shared, own[:200]]), np.concatenate([shared, own[200:]])
    sig = near_dedup.signatures(np.concatenate([a, b]), np.repeat([0, 1], 1000), 2, 160)
    assert abs((sig[0] == sig[1]).mean() - 800 / 1200) < 0.12
    assert len(set((sig[0] >> 32).tolist())) <= 3  # early stop: few ranks were drawn
    one = near_dedup.signatures(a[:1], np.zeros(1, int), 1, 160)
    assert sorted((one[0] >> 32).tolist()) == list(range(160))


def test_words_of_a_long_text_cross_pieces():
    text = "é" * 30 + " " + "ab\tCD\x0be " * 400_000
    parts = list(words(pa.array(["x", None, text, ""])))
    sizes = np.concatenate([c.counts for _, c in parts])
    assert sizes.tolist() == [1, 0, 1 + 3 * 400_000, 0]
    long = next(c for _, c in parts if len(c) == 1)
    assert len(np.unique(long.hashes)) == 4


def test_mixing_meets_targets_and_is_reproducible(spark):
    rows = [(i, "word " * 20, "big") for i in range(3000)] + [(i, "word " * 20, "small") for i in range(3000, 3300)]
    rows += [(9000, None, None), (9001, "", "void"), (9002, "a", "unnamed"), (None, "b", "big")]
    docs = documents(spark, rows)
    weights = {"big": 1.0, "small": 1.0}
    mixed = mixing.mix_sources(docs, weights)
    assert mixed.columns[-3:] == ["copies", "copy", "shuffle_key"] and "root" in mixed.columns
    held = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert abs(held["big"] - 1650) < 200 and abs(held["small"] - 1650) < 200 and "unnamed" not in held
    again = mixing.mix_sources(docs.repartition(5), weights)
    assert mixed.exceptAll(again.select(mixed.columns)).isEmpty()
    for r in mixed.limit(50).collect():
        rate = 1650 / 3000 if r.source == "big" else 5.5 if r.source == "small" else 1.0
        u = int(hashlib.md5(f"11:{'null' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        k, p = 0, math.exp(-rate)
        total = p
        while total <= u:
            k += 1
            p *= rate / k
            total += p
        assert abs(r.copies - k) <= (1 if abs(total - u) < 1e-2 else 0)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_token_rollups_follow_changes_once(spark):
    state = token_counts.Rollups(spark, Workspace(spark, "test").path("rollups"))
    schema = "change string, doc_id long, text string, source string, lang string, sign string"
    plain = token_counts.space_tokens(F.col("text"))

    def commit(batch, *rows, version="space-1", tokens=plain):
        return state.commit(batch, spark.createDataFrame([(*r, "x") for r in rows], schema), version, tokens)

    def totals():
        return sorted(map(tuple, state.totals().collect()), key=repr)

    assert commit("1", ("insert", 1, "a b  c", "s", "en"), ("insert", 2, None, None, "en"), ("insert", 3, "x\ty", "s", "en"),
                  ("insert", 3, "x\ty", "s", "en"), ("insert", None, "q", "s", "en"), ("odd", 8, "q", "s", "en"))
    assert totals() == sorted([("s", "en", "space-1", 2, 5), (None, "en", "space-1", 1, 0)], key=repr)
    assert not commit("1", ("insert", 9, "never", "s", "en"))
    assert commit("2", ("delete", 1, None, "s", "en"), ("delete", 77, None, "s", "en"), ("insert", 3, "again", "s", "en"))
    assert totals() == sorted([("s", "en", "space-1", 1, 2), (None, "en", "space-1", 1, 0)], key=repr)
    text = "revised words, and more"
    bpe = token_counts.bpe_tokens()(F.col("text"))
    assert commit("3", ("revise", 3, text, "t", "de"), ("revise", 1, "gone", "s", "en"), version="bpe", tokens=bpe)
    want = len(encoder(TOKENIZER).encode_ordinary(text))
    assert totals() == sorted([("t", "de", "bpe", 1, want), (None, "en", "space-1", 1, 0)], key=repr)
    assert commit("4") and len(totals()) == 2


def test_token_rollups_read_compacted_state_and_touched_buckets(spark, tmp_path):
    """Random changes, compacted at odd moments, against a dictionary; the state of a document has one row."""
    rng = np.random.default_rng(7)
    state = token_counts.Rollups(spark, str(tmp_path / "state"))
    plain = token_counts.space_tokens(F.col("text"))
    assert not state.compact()
    held = {}
    for batch in range(5):
        ids = rng.choice(40, 12, replace=False).tolist()
        rows = [(["insert", "revise", "delete"][rng.integers(0, 3)], i, "w " * int(rng.integers(0, 9)), f"s{i % 3}", None) for i in ids]
        for change, i, text, source, lang in rows:
            if change == "delete":
                held.pop(i, None)
            elif (change == "insert") != (i in held):
                held[i] = (source, lang, "space-1", len(text.split()))
        assert state.commit(str(batch), spark.createDataFrame(rows, "change string, doc_id long, text string, source string, lang string"), "space-1", plain)
        if batch in (0, 3):
            assert state.compact() and not state.compact()
        assert sorted(tuple(r) for r in state.held().select("doc_id", *token_counts.KEYS, "tokens").collect()) == sorted((i, *v) for i, v in held.items())
        want = {}
        for source, _, _, n in held.values():
            documents, tokens = want.get(source, (0, 0))
            want[source] = (documents + 1, tokens + n)
        assert {r.source: (r.documents, r.tokens) for r in state.totals().collect()} == want
    assert state.batches() == list("01234")
    assert not state.commit("1", spark.createDataFrame([("delete", 1, None, None, None)], "change string, doc_id long, text string, source string, lang string"), "space-1", plain)
    # Only the batch after the last compaction, and the compaction itself, are read.
    files = "".join(state._entries().inputFiles())
    assert "batch=4" in files and "compacted/1" in files and "batch=3" not in files and "compacted/0" not in files


def test_token_counts_query_against_plain_python(spark):
    from feedgate.llm.queries import op3_token_counts

    sf = "/root/testdata/sf0.001"
    encode = encoder(TOKENIZER).encode_ordinary
    first, want = {}, {}
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source", "lang").collect()
    for r in sorted(rows, key=lambda r: r.doc_id):
        if first.setdefault(r.text or "", r.doc_id) == r.doc_id:
            documents, tokens = want.get((r.source, r.lang, "bpe-50k"), (0, 0))
            want[r.source, r.lang, "bpe-50k"] = (documents + 1, tokens + len(encode(r.text or "")))
    found = op3_token_counts(spark, sf).collect()
    assert {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in found} == want


def brute_spans(text):
    out = []
    for m in re.finditer(secrets.ASSIGN.pattern, text, re.I | re.A):
        out += [(m.start(), 0, m.end())] if len(m[2]) >= 6 else []
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else bytes([0x82]) + len(body).to_bytes(2, "big")
    return bytes([tag]) + size + body


RSA = der(0x30, der(2, b"\0"), *[der(2, bytes(range(1, 40)))] * 8)
PKCS8 = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48"), der(5)), der(4, RSA))
EC = der(0x30, der(2, b"\1"), der(4, bytes(range(32))), der(0xA0, der(6, b"\x2a\x86\x48")))


def field(data):
    return len(data).to_bytes(4, "big") + data


SSH = secrets.OPENSSH + field(b"none") + field(b"none") + field(b"") + b"\0\0\0\1" + field(b"public" * 8)


def jwt(header):
    return ".".join(base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=") for x in (header, {"sub": "1"})) + ".c2ln"


def test_secret_spans(spark):
    pem = "-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(RSA).decode() + "-----END RSA PRIVATE KEY-----"
    fake = pem.replace("MIIB", "MIIC", 1) if "MIIB" in pem else pem[:40] + pem[44:]
    texts = {
        "pem": [pem, "é" + pem + "x"],
        "key64": [base64.b64encode(x).decode() for x in (RSA, PKCS8, EC, SSH)],
        "keyhex": [RSA.hex(), EC.hex().upper()],
        "token": ["see " + jwt({"alg": "HS256"}) + " there"],
    }
    for kind, some in texts.items():
        for text in some:
            assert secrets.KINDS.index(kind) in {k for _, k, _ in secrets.spans(text)}, (kind, text)
    for text in (fake, jwt({"typ": "x"}), base64.b64encode(RSA[:-1]).decode(), base64.b64encode(b"a" * 60).decode(), (RSA + b"x").hex()):
        assert not {k for _, k, _ in secrets.spans(text)} & {3, 4, 5, 6}, text
    tricky = [
        "token=secret=abcdef", "PassWord : 'hunter22' api-key=short api_key=\"longenough", "passwd=abc passwd=abcdef",
        "toKen=abcdefgh ſecret=abcdefgh", "AKIA" + "A" * 15, "AKIA" + "A" * 16, "xAKIAAKIA" + "9" * 20, "0" * 23, "g" + "0a" * 12 + "g",
        "", None, "a" * 24 + "=" * 3, "x " * 300_000 + "secret:abcdefg",
    ]
    rows = [(i, t) for i, t in enumerate(tricky)] + [(1, tricky[1]), (None, "token=abcdef")]
    found = secrets.digest(secrets.secret_spans(documents(spark, rows))).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    for i, text in rows:
        want = brute_spans(text or "")
        line = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in want)
        r = by_id[i]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == n for _, k, _ in want) for n in range(3)]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest() and r.spans == line


def test_neighbours_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    points = rng.standard_normal((1500, 16))
    points[200:260] = points[200]
    rows = [(i, [float(x) for x in p], "x") for i, p in enumerate(points)]
    rows += [(1500, None, "x"), (1550, [0.0] * 16, "x"), (1600, [1.0, float("nan")] * 8, "x"), (None, rows[0][1], "x"), (1650, [1.0, 2.0], "x")]
    rows += [(1700, [], "x"), (50, rows[50][1], "x"), (1750, [1.0, None], "x")]
    found = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell string")).collect()
    unit = points / np.linalg.norm(points, axis=1)[:, None]
    got = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 1500, 50))
    hits = 0
    for q, best in got.items():
        cosine = unit @ unit[q]
        cosine[q] = -9
        want = np.lexsort((np.arange(1500), -np.round(cosine, 12)))[:5]
        hits += len(set(want) & {i for i, _ in best})
        assert all(abs(cosine[i] - s) < 1e-12 for i, s in best) and len(best) == 5
    assert hits >= 0.9 * 5 * len(got)
    assert [i for i, _ in got[200]] == [201, 202, 203, 204, 205]
    assert [i for i, _ in got[250]] == [200, 201, 202, 203, 204]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r["rank"], r.vec_id) for r in neighbours.nearest(few).collect()] == [(0, 1, 1)]
    assert neighbours.nearest(few.limit(0)).count() == 0


def test_chi_square_stop():
    draws = np.random.default_rng(0).chisquare(neighbours.M, 200_000)
    for x in (2.0, 8.0, 15.0):
        assert abs(neighbours.chi_square(np.array(x)) - (draws <= x).mean()) < 0.005


def test_segments_are_the_maximal_ones():
    def brute(scores, at=0):
        best = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0,))
        if best[0] <= 0:
            return []
        _, _, _, i, j = best
        return brute(scores[:i], at) + [(at + i, at + j, best[0])] + brute(scores[j:], at + j)

    rng = np.random.default_rng(2)
    for _ in range(150):
        scores = rng.integers(-9, 8, rng.integers(0, 14)) + rng.random() * 0.01
        got = toxicity.segments(scores.astype(float))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute(scores.tolist())]


def test_toxicity_learns_and_survives(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(900):
        own = prose(rng, 60).split()
        if i % 4 == 0:
            own[rng.integers(0, 60)] = f"vile{rng.integers(0, 6)}"
            own[rng.integers(0, 60)] = f"vile{rng.integers(0, 6)}"
        rows.append((i, " ".join(own)))
        labels.append((i, int(i % 4 == 0)))
    rows += [(1000, None), (1001, ""), (None, "vile1"), (1002, "w1 " * 300_000 + "vile1 vile2 vile3"), (1000, None)]
    again = "vile1 vile2 vile3 vile4 vile5"
    rows += [(1003, f"{prose(rng, 200)} {again} {prose(rng, 300)} {again} {prose(rng, 200)}")]
    labels += [(1001, None), (None, 1), (3, 7), (5000, 1)]
    docs, known = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity.toxic_passages(docs, known)
    found = toxicity.digest(scored).collect()
    # The same passage again, in the same words, is a passage again.
    passages = scored.where("doc_id = 1003").first().passages
    assert [(p.first, p.end) for p in passages] == [(200, 205), (505, 510)] and all(p.chance <= 0.01 for p in passages)
    assert len(found) == len(rows)
    held = [r for r in found if r.held_out and r.doc_id < 900]
    assert {r.doc_id for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in held) >= 0.97 * len(held)
    assert all(r.predicted == 0 for r in found if r.doc_id in (1000, 1001)) and all(0 <= r.score <= 1 for r in found)
    blind = toxicity.digest(toxicity.toxic_passages(docs, known.limit(0)))
    assert blind.where("predicted = 1").isEmpty() and toxicity.toxic_passages(docs.limit(0), known).count() == 0


def test_alignment_against_full_table():
    rng = np.random.default_rng(6)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 12))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
            step = decontaminate.MATCH if a[i - 1] == b[j - 1] else decontaminate.MISMATCH
            table[i, j] = max(0, table[i - 1, j - 1] + step, table[i - 1, j] + decontaminate.GAP, table[i, j - 1] + decontaminate.GAP)
        assert decontaminate.align(a, b)[0] == table.max()


def test_decontamination_finds_copies_and_edits(spark):
    rng = np.random.default_rng(8)
    items = [(i, " ".join(f"b{x}" for x in rng.integers(0, 300, 30))) for i in range(20)] + [(20, "Tiny item"), (21, ""), (22, None)]
    rows = [(i, prose(rng, 100) + " " + items[i % 20][1].upper().replace(" ", ", ") + " " + prose(rng, 50)) for i in range(40)]
    for i in range(40, 60):
        own = items[i % 20][1].split()
        for j in rng.choice(30, 4, replace=False):
            own[j] = "edited"
        rows.append((i, prose(rng, 30) + " " + " ".join(own[:10] + ["inserted"] + own[10:])))
    rows += [(i, prose(rng, 200)) for i in range(60, 90)]
    rows += [(90, "a tiny, ITEM here"), (91, None), (92, ""), (93, "tiny thing item"), (94, "x " * 400_000 + items[3][1]), (0, rows[0][1])]
    table = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, gram string")
    found = decontaminate.contaminated(documents(spark, rows), table).collect()
    got = collections.Counter((r.doc_id, r.item_id) for r in found)
    want = collections.Counter([(i, i % 20) for i in range(60)] + [(90, 20), (94, 3), (0, 0)])
    assert got == want
    assert all(r.score == 1.0 for r in found if r.doc_id < 40) and all(0.6 <= r.score < 1 for r in found if 40 <= r.doc_id < 60)
    assert decontaminate.contaminated(documents(spark, rows), table.limit(0)).count() == 0
    assert decontaminate.contaminated(documents(spark, rows).limit(0), table).count() == 0


def test_decontamination_finds_every_edit_up_to_the_least_score(spark):
    rng = np.random.default_rng(12)
    items = [(n, " ".join(f"b{x}" for x in rng.choice(150, n, replace=False))) for n in range(8, 21)]
    texts = []
    for n, item in items:
        words_of, points = item.split(), math.floor(2 * n * (1 - decontaminate.LEAST_SCORE) + 1e-9)
        for kind in ("changed", "left out", "put in", "mixed", "mixed", "too many"):
            own, at = [[x] for x in words_of], rng.permutation(n - 2) + 1
            left = points + 1 if kind == "too many" else points
            if kind in ("changed", "left out"):
                # Evenly, so that runs of unchanged words are as short as they can be.
                for i in range(left // 3):
                    own[(i + 1) * (n + 1) // (left // 3 + 1) - 1] = ["new"] if kind == "changed" else []
            else:
                if kind == "mixed":
                    for i in at[: left // 6]:
                        own[i] = ["new"] if i % 2 else []
                    left -= left // 6 * 3
                for i in rng.permutation(n - 1)[:left]:
                    own[i] = own[i] + ["more"]
            texts.append(prose(rng, 40) + " " + " ".join(sum(own, [])) + " " + prose(rng, 40))
    # What survives an edit also occurs elsewhere, and so is more common than what does not.
    texts += [" ".join(rng.permutation(x.split("new"))) for x in texts]
    rows = list(enumerate(texts))

    def hashed(text):
        return next(words(pa.array([text]), punctuation=True))[1].hashes

    want = {}
    for (i, text), (n, item) in itertools.product(rows, items):
        score = decontaminate.align(hashed(item), hashed(text))[0] / (2 * n)
        if score >= decontaminate.LEAST_SCORE:
            want[i, n] = score
    found = decontaminate.contaminated(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): r.score for r in found} == want
    assert {i for i in range(len(items) * 6) if i % 6 < 5} <= {i for i, _ in want}


def test_decontamination_disregards_case_in_all_scripts(spark):
    items = [
        (1, "Según él, ñandú y cigüeña están aquí; además órbita única, época íntima y ácido"),
        (2, "Съешь же ещё этих мягких французских булок да выпей чаю сейчас"),
        (3, "ὁ λόγος ὅτι Ἀθῆναι πόλις μεγάλης σοφίας τε καὶ τέχνης"),
        (4, "çok güzel"),
        (5, "große Straße"),
    ]
    rows = [(10 * i + k, f"vorher {t} nachher") for i, text in items for k, t in enumerate((text, text.upper(), text.lower()))]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(documents(spark, rows), table).collect()
    assert sorted((r.doc_id, r.item_id, r.score) for r in found) == [(i, i // 10, 1.0) for i, _ in rows]
    broken = pa.array([b"\xff \xc3\x89 ", b""], pa.binary()).view(pa.string())
    assert [(at, chunk.counts.tolist()) for at, chunk in words(broken, punctuation=True, folded=True)] == [(0, [2, 0])]
    # Operator 1 keeps to A-Z.
    plain, other = next(words(pa.array(["é", "É"])))[1].hashes
    assert plain != other


def test_decontamination_keeps_items_that_share_an_id_apart(spark):
    rng = np.random.default_rng(13)
    texts = [" ".join(f"b{x}" for x in rng.integers(0, 300, n)) for n in (12, 30, 25, 16, 40, 9)]
    items = [(0, texts[0]), (0, texts[1]), (1, texts[2]), (None, texts[3]), (None, texts[4]), (0, texts[5]), (7, texts[5])]
    rows = [(i, prose(rng, 20) + " " + t + " " + prose(rng, 20)) for i, t in enumerate(texts)]
    rows.append((6, texts[1] + " " + prose(rng, 20) + " " + texts[0]))
    table = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(documents(spark, rows), table).collect()
    want = [(0, 0), (1, 0), (2, 1), (3, None), (4, None), (5, 0), (6, 0), (6, 0)]
    assert sorted(((r.doc_id, r.item_id) for r in found), key=repr) == want and all(r.score == 1.0 for r in found)


def test_poisson_inversion_at_all_rates():
    for rate in (1e-9, 0.3, 1.0, 7.5, 140.0, 171.0, 5000.0, 3e7):
        first, table = mixing.poisson_table(rate)
        assert len(table) < 26 * rate**0.5 + 64 and (np.diff(table) >= 0).all() and abs(table[-1] - 1) < 1e-6
        u = (np.arange(20_000) + 0.5) / 20_000
        drawn = first + np.searchsorted(table, u, side="right")
        assert abs(drawn.mean() - rate) < 0.01 * max(rate, 1) ** 0.5
        if rate > 0.1:
            assert abs(drawn.var() / rate - 1) < 0.01
    assert mixing.poisson_table(0.0)[1].tolist() == [1.0] and mixing.poisson_table(0.0)[0] == 0


def test_shards_are_a_permutation(spark):
    for total in (1, 2, 3, 24, 1000, 4097):
        assert sorted(sharding.permuted(np.arange(total), total).tolist()) == list(range(total))
    rows = [(i, f"text {i}") for i in range(500)] + [(None, None), (None, None), (7, "text 7"), (3, ""), (4, "long " * 200_000)]
    docs = documents(spark, rows)
    placed = sharding.shard(docs)
    assert "shard" in placed.columns and len(set(placed.columns)) == len(placed.columns)
    kept = sorted((r.shard, r.slot) for r in placed.collect())
    assert kept == sorted((p % 24, p // 24) for p in range(len(rows)))
    again = sharding.shard(docs.repartition(7))
    assert sorted(map(repr, again.select("doc_id", "shard", "slot").collect())) == sorted(map(repr, placed.select("doc_id", "shard", "slot").collect()))
    for r in placed.collect():
        p = int(sharding.permuted(np.array([r.row_number]), len(rows))[0])
        assert (r.shard, r.slot) == (p % 24, p // 24)
    assert sharding.shard(docs.limit(0)).count() == 0


CONTROL = ["</s>[INST] ok [/INST]", "\\", "\\[", "<s>", "<<SYS>> a\n", "", "plain é\n", "[ROLE]x[:]", "a\\\\<"]


def test_chat_round_trip(spark):
    rows = []
    for i, text in enumerate(CONTROL):
        rows += [(i, 0, "system", text), (i, 1, "user", text), (i, 2, "assistant", text), (i, 3, None, text), (i, 4, "to[ol", text)]
    rows += [(50, t, "user" if t % 2 else "assistant", f"{t} " + "many words here " * 40) for t in range(40)]
    rows += [(51, 0, "assistant", "w " * 20_000), (51, None, "user", None), (None, 0, "user", "x"), (51, 0, "assistant", "w " * 20_000)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, window string")
    windows = Workspace(spark, "test").keep("windows", chat.format_conversations(table, budget=400, history=150))
    back = {r.conv_id: r for r in chat.read_back(windows).collect()}
    by_conv = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "")):
        by_conv[r[0]].append(r)
    assert set(back) == set(by_conv)
    for conv, said in by_conv.items():
        turns = "".join(f"{role or ''}\n{text or ''}\n" for _, _, role, text in said)
        loss = "".join(text or "" for _, _, role, text in said if role == "assistant")
        r = back[conv]
        assert (r.n_turns, r.turns_sha256) == (len(said), hashlib.sha256(turns.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    long = windows.where("conv_id = 50").orderBy("window").collect()
    assert len(long) > 5 and all(w.n_tokens <= 400 and not w.over_budget for w in long)
    assert all(w.n_repeated >= 1 for w in long[1:]) and windows.where("over_budget").count() == 2
    for w in windows.where("conv_id < 9").collect():
        assert w.n_repeated == 0 or chat.turns(w.text)[0][0] == "system"
    assert chat.format_conversations(table.limit(0)).count() == 0


def test_url_filter_as_of(spark):
    entries = [
        ("bad.example", "2024-01-10", "block"), ("bad.example", "2024-03-01", "remove"), ("bad.example", "2024-05-01", "block"),
        ("ok.bad.example", "2024-01-01", "allow"), ("bad.example/ads", "2024-03-15", "block"), ("x.example", "2024-01-01", "allow"),
        ("x.example", "2024-01-01", "block"), (None, "2024-01-01", "block"), ("y.example", None, "block"), ("y.example", "2024-01-01", "odd"),
    ]
    cases = [
        (1, "http://bad.example/p", "2024-01-09", None), (2, "https://BAD.example:80/p?q", "2024-01-10", "block"),
        (3, "http://a.b.bad.example", "2024-02-29", "block"), (4, "http://bad.example/", "2024-03-01", None),
        (5, "http://ok.bad.example/z", "2024-02-01", "allow"), (6, "http://bad.example/ads/1", "2024-04-01", "block"),
        (7, "http://bad.example/adsense", "2024-04-01", None), (8, "http://bad.example/x", "2030-01-01", "block"),
        (9, "http://notbad.example/", "2024-02-01", None), (10, None, "2024-02-01", None), (11, "no url", "2024-02-01", None),
        (12, "http://x.example/", "2024-02-01", "block"), (13, "http://x.example/", None, None), (14, "http://y.example/", "2024-02-01", None),
        (14, "http://y.example/", "2024-02-01", None), (15, "http://u@bad.example./" + "a/" * 5000, "2024-02-01", "block"),
        (16, "http://bad.example" + "/b" * 60_000, "2024-02-01", "block"), (17, f"http://{'a.' * 20_000}ok.bad.example/ads", "2024-04-01", "allow"),
        (18, "http://bad.example//ads", "2024-04-01", None), (19, "http://bad.example/ads//x", "2024-04-01", "block"),
    ]
    table = spark.createDataFrame([(*c[:3], "x") for c in cases], "page_id long, url string, fetch_day string, host string")
    log = spark.createDataFrame(entries, "rule string, day string, action string")
    found = sorted((r.page_id, r.action or "") for r in url_filter.evaluate(table, log).collect())
    assert found == sorted((c[0], c[3] or "") for c in cases)
    plan = url_filter.evaluate(table, log)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert url_filter.evaluate(table, log.limit(0)).where("action is not null").isEmpty()
    assert url_filter.evaluate(table.limit(0), log).count() == 0
