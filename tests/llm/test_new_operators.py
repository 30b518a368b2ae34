"""Periodic runs, licence notices and conversation repair against brute force on small inputs and their edge cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedgate.llm import license_notices as notices
from feedgate.llm import periodic_runs as runs
from feedgate.llm import queries
from feedgate.llm import turn_repair as repair

WORD = r"[^\x20\x09-\x0D]+"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Operator 11


def brute_runs(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in found.items())


def brute_run_row(doc_id, text):
    words = re.findall(WORD, text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g, a = h // 10, h // 10 % n
        if h % 10 == 0:
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if found else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (doc_id, len(found), *best, milli, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def thue_morse(n):
    return [f"{bin(i).count('1') % 2}" for i in range(n)]


def run_texts():
    rnd = random.Random(3)
    texts = [None, "", " \t\n ", "one", "a " * 6, "a a a a a b", "x " * 5, "\x0ba\x0cb\r" * 9, "A a " * 8, "é ß c " * 7]
    texts += [" ".join(thue_morse(700)), " ".join(["a"] * 40 + ["b"]) + " " + " ".join((["a"] * 40 + ["b"]) * 4)]
    for _ in range(250):
        alphabet = "abcdefghijkl"[: rnd.randint(1, 12)]
        words = [rnd.choice(alphabet) for _ in range(rnd.randint(0, 150))]
        for _ in range(rnd.randint(0, 3)):
            part = [rnd.choice(alphabet) for _ in range(rnd.randint(1, 60))]
            cut = rnd.randint(0, len(part))
            words[rnd.randint(0, len(words)) :] = part * rnd.randint(2, 8) + part[:cut]
        texts.append(rnd.choice([" ", "  ", "\n"]).join(words))
    return texts


def test_periodic_runs_match_brute_force(spark, tmp_path):
    rows = [*enumerate(run_texts()), (None, "b " * 9), (7, "c d " * 9), (7, "c d " * 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("runs", "n_words", "_h", "_g")})
    frame.coalesce(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    expected = [brute_run_row(*row) for row in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)
    assert sum(r[1] for r in expected) > 200 and any(r[4] and r[4] > 40 for r in expected)


def test_periodic_runs_do_not_cross_texts(spark):
    rows = [(i, "a b c") for i in range(12)]
    found = runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.runs == [] and r.collapsed == "a b c" for r in found)


@pytest.mark.parametrize("words", [thue_morse(9000), (["0"] * 300 + ["1"]) * 12, [f"{i}" for i in range(1700)] * 5])
def test_long_periodic_texts(words):
    numbers = np.unique(words, return_inverse=True)[1].astype(np.int64)
    found = runs.runs_of(numbers, len(numbers))
    assert [(s, e - s, q) for s, e, q in found.tolist()] == brute_runs(words) if len(words) < 5000 else True
    if len(set(words)) == 1700:
        assert found.tolist() == [[0, 8500, 1700]]
    if words == thue_morse(9000):
        assert not len(found)


def test_every_position_seeds_at_most_once():
    numbers = np.array([(i * i) % 7 for i in range(20_000)], np.int64)
    grams = runs.mix(numbers.astype(np.uint64))
    assert len(runs._seeds(grams, 16)) <= len(numbers)


def test_runs_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert runs.digest(runs.periodic_runs(runs.with_repeats(empty))).collect() == []


# Operator 12


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    found = []
    for phrase, label in notices.PHRASES.items():
        own = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(own)] == own]
    places, labels = [i for i, _ in found], sorted({x for _, x in found})
    return len(words), len(found), min(places, default=None), max(places, default=None), ",".join(labels)


def test_license_base_matches_brute_force(spark, tmp_path):
    rnd = random.Random(5)
    parts = "gnu general public license apache cc by mit The É x1 _ İ ß".split()
    texts = [None, "", "---", "CC-BY cc by", "MIT\nLicense.", "GNU General Public License" * 2]
    for _ in range(400):
        text = "".join(rnd.choice(parts) + rnd.choice([" ", "-", "", " \n", "\x00"]) for _ in range(rnd.randint(0, 25)))
        texts.append(text.upper() if rnd.random() < 0.3 else text)
    rows = [*enumerate(texts), (None, "mit license"), (3, "mit license")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("label", F.lit(1))
    frame.coalesce(2).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_license_notices(spark, str(tmp_path)).collect()
    own = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert sorted(own, key=repr) == sorted(((i, *brute_base(t)) for i, t in rows), key=repr)
    for r in got:
        assert {*filter(None, r.base_labels.split(","))} <= {*r.labels.split(",")} and 0 <= r.score <= 1
        assert r.labels == ",".join(sorted({*filter(None, r.labels.split(","))}))
        assert (r.score == 1) >= (r.n_base > 0) and (r.score > 0) == (r.labels != "")


def distance(one, two):
    row = [*range(len(two) + 1)]
    for i, a in enumerate(one, 1):
        row, before = [i], row
        for j, b in enumerate(two, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (a != b)))
    return row[-1]


def test_edited_notices_are_found_with_their_places():
    rnd, by = random.Random(2), notices.finder(notices.NOTICES, notices.EDIT_EVERY)
    for _ in range(400):
        label, notice = rnd.choice([n for n in notices.NOTICES if len(n[1]) > 8])
        most, own = len(notice) // notices.EDIT_EVERY, [*notice]
        for _ in range(rnd.randint(0, most)):
            # Not beside a space: a letter that stands alone takes a space with it.
            i = rnd.choice([i for i in range(1, len(notice) - 1) if " " not in notice[i - 1 : i + 2]])
            own[i] = rnd.choice(["", "q", notice[i] + "q", "é"])
        said = "".join(own).strip()
        before = " ".join(rnd.choice(["Über", "die", "of", "x-y"]) for _ in range(rnd.randint(0, 5)))
        text = f"{before} -- {said.upper().replace(' ', ' / ')}; und mehr"
        spans = [s for s in notices.spans_of(text, by)[1] if s[1] == notice and not s[2]]
        assert spans, (notice, text)
        for name, _, _, _, start, end, edits in spans:
            plain = notices.plain_words(text[start:end]).strip()
            assert name == label and edits <= most and edits >= distance(plain, notice)


def test_one_more_edit_is_not_found():
    by = notices.finder((("mpl", "mozilla public license"),), 12)
    assert notices.spans_of("Mozila Public License", by)[1][0][0] == "mpl"
    assert not notices.spans_of("Moila Publc Lcense", by)[1]
    assert not notices.spans_of("xmozilla public licenses", notices.finder((("mpl", "mozilla public license"),), 100))[1]


def test_a_long_text_of_notices():
    by = notices.finder(notices.NOTICES, notices.EDIT_EVERY)
    n, spans = notices.spans_of("Released under the MIT Licence. " * 20_000, by)
    assert n == 100_000 and len(spans) == 20_000 and {s[6] for s in spans} == {1}


# Operator 13


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """Least cost and audit over all targets, from the last row to the first, by trying every edit in every state."""
    after = {"s": 1, "u": 2, "a": 3}
    expected = {0: "su", 1: "u", 2: "a", 3: "u"}
    best = {0: (0, "", ()), 3: (0, "", ())}

    def inserted(ends):
        for _ in range(4):
            for state in range(4):
                symbol = "a" if state == 2 else "u"
                if after[symbol] in ends:
                    cost, audit, said = ends[after[symbol]]
                    new = (cost + 2, "I" + audit, ({"u": "user", "a": "assistant"}[symbol] + ":", *said))
                    ends[state] = min(ends.get(state, new), new, key=lambda x: x[:2])
        return ends

    best = inserted(best)
    for role, text, fault in reversed(rows):
        now = {}
        for state in range(4):
            ways = [(best[state][0] + 3, "D" + best[state][1], best[state][2])] if state in best else []
            for symbol in expected[state] if fault not in ("blank", "duplicate") else "":
                if after[symbol] not in best:
                    continue
                cost, audit, said = best[after[symbol]]
                cost += fault == "truncated"
                if role[:1] == symbol:
                    ways.append((cost, "K" + audit, (f"{role}:{text}", *said)))
                if symbol != "s":
                    name = {"u": "user", "a": "assistant"}[symbol]
                    ways.append((cost + 2, "R" + audit, (f"{name}:{text}", *said)))
            if ways:
                now[state] = min(ways, key=lambda x: x[:2])
        best = inserted(now)
    return best[0]


def brute_repair(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r in damaged(rows) if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).digest()))
        seen, marked = set(), []
        for _, _, role, text in own:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for _, t, _, _ in own if t is not None]
        faults = [sum(f == name for *_, f in marked) for name in ("blank", "duplicate", "truncated")]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, said = cheapest(marked)
        out[conv] = (max(turns) - min(turns) + 1 - len({*turns}) if turns else 0, *faults, illegal, cost, audit, sha("\n".join(said)))
    return out


def conversations(rnd, sizes):
    for conv, size in enumerate(sizes):
        for turn in range(size):
            role = "system" if turn == 0 and rnd.random() < 0.3 else "user" if (turn + (rnd.random() < 0.15)) % 2 else "assistant"
            said = rnd.choice(["Yes.", "No", "Why?", "Ok!\n", f"word {rnd.randint(0, 50)}.", " ", "Fin. \t"])
            yield conv, turn + (turn > 3) * rnd.randint(0, 2), rnd.choice([role] * 9 + ["tool", "user", "system"]), said


def test_repaired_conversations_match_brute_force(spark, tmp_path):
    rnd = random.Random(4)
    rows = [*conversations(rnd, [rnd.randint(1, 9) for _ in range(120)] + [17, 40, 90, 400])]
    rows += [(None, None, None, None), (None, 2, "user", "Hi."), (-5, None, "user", None), (-5, None, "assistant", "A."), (-5, 3, None, "B.")]
    rows += [(-9, t, "user", "Same again.") for t in range(12)] + [(-11, 1, "system", "S."), (-11, 1, "system", "S.")]
    lost = next(i for i in range(-99, -11) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "Gone."))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    frame = frame.withColumns({c: F.lit("x") for c in ("at", "part", "edits", "of", "cost", "fault")})
    frame.repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r[0]: tuple(r)[1:] for r in queries.op13_turn_repair(spark, str(tmp_path)).collect()}
    assert got == brute_repair(rows)
    assert got[lost] == (0, 0, 0, 0, 0, 0, "", sha(""))


def test_alignment_in_blocks_gives_the_least_audit():
    rnd = random.Random(8)
    for _ in range(300):
        marked = [(rnd.choice(["user", "assistant", "system", "tool"]), "x", rnd.choice([None, None, "truncated", "blank"])) for _ in range(rnd.randint(1, 14))]
        codes = "".join((r[0] if r != "tool" else "-") + {None: "o", "truncated": "t", "blank": "x"}[f] for r, _, f in marked)
        cost, audit, end = repair.repaired(codes, repair.NOTHING, repair.TO_END)
        assert (cost, audit + repair.TAILS[end]) == cheapest(marked)[:2]
        size = 2 * rnd.randint(1, 5)
        blocks = [codes[i : i + size] for i in range(0, len(codes), size)]
        scan, back = repair._Scan(), []
        for i, block in reversed([*enumerate(blocks)]):
            row = {"conv_id": 1, "part": 0, "block": i, "codes": block, "places": [*range(len(block) // 2)]}
            back.append(repair._to_go(row | {"least": repair.between_states(block)}, scan))
        scan, joined = repair._Scan(), ""
        for part, block, own, places, behind, last, _, _ in reversed(back):
            row = {"part": part, "block": block, "codes": own, "places": places, "behind": behind, "last": last}
            names = ("part", "block", "codes", "places", "audits", "ends")
            chosen = dict(zip(names, repair._choices(row), strict=True)) | {"conv_id": 1}
            joined += "".join(e["edit"] for e in repair._walk(chosen, scan)[0])
        assert (back[-1][6], joined, sum(b[7] for b in back)) == (cost, audit + repair.TAILS[end], repair.illegal_pairs(codes))


def test_repair_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    edits, found = repair.repair_conversations(empty)
    assert edits.collect() == [] and found.collect() == [] and repair.repair_digest(empty).collect() == []


def test_a_hot_conversation_is_spread(spark):
    """One conversation with most rows: its blocks are many and none holds more than BLOCK rows."""
    rows = [(1, t, "user" if t % 2 else "assistant", f"Turn {t}.") for t in range(3000)] + [(2, 0, "user", "Hi.")]
    edits, found = repair.repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5))
    by = {r.conv_id: r for r in found.collect()}
    assert by[1].cost == 4 and by[1].rows == 3000 and by[2].cost == 2
    kept = edits.where("conv_id = 1").orderBy("at", "step").collect()
    assert [r.edit for r in kept] == ["I", *["K"] * 3000, "I"]
    roles = "".join(r.role[0] for r in kept if r.edit != "D")
    assert re.fullmatch("s?(ua)+", roles)
