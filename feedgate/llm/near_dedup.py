"""Operator 1: near-duplicate groups by SuperMinHash, banding, verification and union-find.

A document is the set of its distinct word shingles. SuperMinHash gives every element a permutation of the
registers and correlated ranks; an element's later ranks are only drawn while a register of its document is
still empty, so long documents stop after two or three draws. Bands of registers bring similar sets into
buckets, links are confirmed on the full sets, and components are found by distributed union-find.

One link per copy is enough, so pairs are tried in rounds. In a star round every set is compared with one other: the
smallest set of a bucket, of those not yet connected with it the one it shares most buckets with. Only buckets that
still hold several components after that are compared in pairs, across components alone: small ones by a join, large ones
in pairs of blocks, where a local union-find keeps the links that connect something new.

Defined results: null or empty text and text of white space only have the empty set, link with nothing and
form a component of their own. Rows with the same words are one node, whatever their number. A null
``doc_id`` is kept out of the minimum; such a row shows the component's smallest id and is not kept. Rows
that repeat a ``doc_id`` get one result each. Other columns, whatever their names, are not read. An empty
table gives an empty result.

Bounds: the number of bands follows from the threshold, so that a pair exactly at it shares no band with
probability 5e-6 and is estimated too low with probability 3e-6; more similar pairs are safer. Nodes are 64-bit hashes of whole sets: among n different sets, about n * n / 4e19 pairs are mistaken.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedgate.llm.batches import bounded_batches
from feedgate.llm.components import components
from feedgate.llm.words import mix, odd_constants, sets, words
from feedgate.plans.workspace import Workspace

BAND_ROWS = 5
# Probability to lose a link exactly at the threshold, first by sharing no band, then by an estimate too low.
MISS = 5e-6
SIGMAS = 4.5
# What star rounds leave in several components is compared in pairs: by a join in buckets of up to so many rows, in pairs of
# blocks in larger ones.
STAR_ROUNDS = 3
JOIN_UP_TO = 20
BLOCK = 400
MOST_REGISTERS = 5_000
SLICE = 1 << 15
FILTER_BITS = 1 << 23


def bands_for(percent: int) -> int:
    """Bands that a pair at the threshold all misses with probability MISS at most."""
    if not 0 < percent < 100:
        raise ValueError("the threshold is a percentage above 0 and below 100")
    bands = math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** BAND_ROWS))
    if bands * BAND_ROWS > MOST_REGISTERS:
        raise ValueError(f"a threshold of {percent} % needs {bands * BAND_ROWS} registers")
    return bands


def least_agreement(percent: int) -> int:
    """Registers that must agree before a pair is compared in full."""
    registers, share = bands_for(percent) * BAND_ROWS, percent / 100
    return math.floor(registers * share - SIGMAS * math.sqrt(registers * share * (1 - share)))


def signatures(elements: np.ndarray, doc: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """SuperMinHash: element e draws, for j = 0, 1, ..., rank j + u on the j-th register of its permutation.

    The least rank of a register stays. Once all registers of a document hold ranks below j + 1, further draws
    could only be larger, and its elements stop.
    """
    best = np.full((docs, registers), np.iinfo(np.int64).max, np.int64)
    for at in range(0, len(elements), SLICE):
        _draw(elements[at : at + SLICE], doc[at : at + SLICE], best)
    return best


def _draw(elements: np.ndarray, doc: np.ndarray, best: np.ndarray) -> None:
    registers = best.shape[1]
    order = np.tile(np.arange(registers, dtype=np.uint16), (len(elements), 1))
    flat, rows = best.reshape(-1), np.arange(len(elements))
    own, place = np.unique(doc, return_inverse=True)
    for j in range(registers):
        draw = mix(elements[rows] ^ mix(np.full(1, j, np.uint64)))
        pick = j + (((draw >> np.uint64(40)) * np.uint64(registers - j)) >> np.uint64(24)).astype(np.int64)
        register = order[rows, pick].astype(np.int64)
        order[rows, pick] = order[rows, j]
        rank = (np.int64(j) << 32) | (draw & np.uint64(0xFFFFFFFF)).astype(np.int64)
        np.minimum.at(flat, doc[rows] * registers + register, rank)
        unsettled = best[own].max(axis=1) >= (np.int64(j + 1) << 32)
        rows = rows[unsettled[place[rows]]]
        if not len(rows):
            break


def set_id(shingles: np.ndarray) -> int:
    """64-bit hash of a whole sorted set."""
    if not len(shingles):
        return 0
    with np.errstate(over="ignore"):
        one = np.sum(mix(shingles), dtype=np.uint64) + np.uint64(len(shingles))
        two = np.bitwise_xor.reduce(mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
        return int(mix(np.array([one * np.uint64(0x9E3779B97F4A7C15) ^ mix(np.array([two]))[0]]))[0].astype(np.int64))


def _prints(shingle: int, bands: int, band_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = odd_constants(band_rows)
        salt = mix(np.arange(bands, dtype=np.uint64))
        for batch in batches:
            for at, chunk in words(batch.column(1)):
                each = sets(chunk, shingle)
                sizes = np.array([len(x) for x in each], np.int64)
                doc = np.repeat(np.arange(len(each)), sizes)
                elements = np.concatenate(each) if each else np.zeros(0, np.uint64)
                sig = signatures(elements, doc, len(each), bands * band_rows).astype(np.uint64)
                keys = mix((sig.reshape(len(each), bands, band_rows) * factors).sum(axis=2, dtype=np.uint64) ^ salt)
                flat = pa.array(keys.astype(np.int64).ravel())
                ends = np.arange(0, len(each) * bands + 1, bands, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(each)),
                        pa.array(sizes),
                        pa.array([set_id(x) for x in each], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), flat),
                        pa.array([bytes(x) for x in (sig & np.uint64(0xFF)).astype(np.uint8)], pa.binary()),
                        batch.column(2).slice(at, len(each)),
                    ],
                    ["doc_id", "n_shingles", "node", "bands", "sig", "of_text"],
                )

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, chunk in words(batch.column(0)):
                each = sets(chunk, shingle)
                ends = np.concatenate([[0], np.cumsum([len(x) for x in each])]).astype(np.int32)
                flat = np.concatenate(each) if each else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([set_id(x) for x in each], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int64))),
                    ],
                    ["node", "shingles"],
                )

    return run


def _spanning(percent: int):
    """Links of a block pair that connect different components, confirmed on the full sets.

    A pair is looked at in the bucket of its first common band alone, and only while no link has connected its
    components here. Signatures that agree too rarely end it early.
    """
    registers, least = bands_for(percent) * BAND_ROWS, least_agreement(percent)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(rows["sig"]), np.uint8).reshape(-1, registers)
        bands = np.stack(rows["bands"].to_numpy())
        sets_of = [np.asarray(x, np.int64).view(np.uint64) for x in rows["shingles"]]
        node, label, block, n = (rows[c].to_numpy().copy() for c in ("node", "root", "block", "n"))
        bucket = rows["bucket"].iat[0]
        left, right = np.flatnonzero(block == rows["low"].iat[0]), np.flatnonzero(block == rows["high"].iat[0])
        found = []
        for i in left:
            to = right[(np.minimum(n[right], n[i]) * 100 >= np.maximum(n[right], n[i]) * percent) & (label[right] != label[i])]
            to = to[(sig[to] == sig[i]).sum(axis=1) >= least]
            to = to[bands[i][(bands[to] == bands[i]).argmax(axis=1)] == bucket]
            for j in to:
                if label[j] == label[i]:
                    continue
                shared = len(np.intersect1d(sets_of[i], sets_of[j], assume_unique=True))
                if shared * 100 >= (n[i] + n[j] - shared) * percent:
                    found.append((node[i], node[j]))
                    label[label == label[j]] = label[i]
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return run


def _blocks(rows: DataFrame) -> DataFrame:
    """Rows of large buckets dealt to pairs of blocks of about BLOCK rows."""
    blocks = F.ceil(F.col("rows") / BLOCK)
    own = rows.withColumn("block", F.pmod(F.xxhash64("node", F.lit(1)), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int")))
    )
    return own.select(
        "bucket", "node", "root", "n", "sig", "bands", "shingles", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )


def _agreement(left: pd.Series, right: pd.Series) -> pd.Series:
    """In how many registers two signatures agree."""
    if not len(left):
        return pd.Series([], dtype="int32")
    a, b = (np.frombuffer(b"".join(x), np.uint8).reshape(len(left), -1) for x in (left, right))
    return pd.Series((a == b).sum(axis=1).astype(np.int32))


def maybe_in(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows whose id may be among ``ids``: a bitmap of FILTER_BITS hashed ids, so its broadcast has a fixed size.

    It lets more rows pass as the ids grow, and never drops a row that is among them.
    """
    part = 8 * 4096

    def place(c):
        return F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))

    at = place(ids.columns[0])
    bits = ids.select((at / part).cast("int").alias("_part"), (at % part).alias("_bit"))
    bits = bits.groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    asked = rows.withColumn("_at", place(column)).withColumn("_part", (F.col("_at") / part).cast("int"))
    byte = F.expr(f"cast(conv(hex(substring(_bits, cast(_at % {part} div 8 as int) + 1, 1)), 16, 10) as int)")
    is_set = F.expr("cast(pow(2, _at % 8) as int)")
    found = asked.join(F.broadcast(bits), "_part").where(byte.bitwiseAND(is_set) != 0)
    return found.select(rows.columns)


def near_duplicates(docs: DataFrame, shingle: int = 3, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    Links: 100 * intersection >= percent * union. Signatures decide which pairs are worth the full sets, and only
    for these texts are sets built again. Working tables go as soon as the result no longer reads them.
    """
    work = Workspace(docs.sparkSession, "near-dedup")
    found = _grouped(docs, shingle, percent, work)
    work.only("prints", "names")
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _text_hash(docs: DataFrame):
    """Tells rows of one id apart."""
    return F.xxhash64(docs["text"].cast("string"))


class _Links:
    """Confirmed links between nodes (different sets), and the components they make so far."""

    def __init__(self, text: DataFrame, filled: DataFrame, lows: DataFrame, shingle: int, percent: int, work: Workspace):
        self.text, self.filled, self.lows = text, filled, lows
        self.shingle, self.percent, self.work = shingle, percent, work
        self.sets: DataFrame | None = None
        self.roots: DataFrame | None = None
        self.tried: DataFrame | None = None

    def first_copies(self, nodes: DataFrame, *columns: str) -> DataFrame:
        """The given columns of one row for each node. Joined on node and id, so many copies of a node spread out."""
        of = self.lows.join(nodes, "node", "left_semi").select(F.col("node").alias("of"), "low")
        same = (F.col("node") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("low"))
        return self.filled.join(of, same, "left_semi").select("node", *columns).dropDuplicates(["node"])

    def build_sets(self, name: str, nodes: DataFrame) -> None:
        """The shingles of nodes that have none yet, built anew from one text of each."""
        wanted = self.lows.join(nodes, "node", "left_semi")
        if self.sets is not None:
            wanted = wanted.join(self.sets, "node", "left_anti")
        wanted = self.work.keep(f"{name}_wanted", wanted)
        if wanted.isEmpty():
            return
        ids = wanted.select(F.col("low").alias("wanted_id")).distinct()
        same = F.col("doc_id").eqNullSafe(F.col("wanted_id"))
        texts = maybe_in(self.text, ids, "doc_id").join(ids, same, "left_semi").select("text")
        built = texts.mapInArrow(_sets(self.shingle), "node long, shingles array<long>")
        built = self.work.keep(f"{name}_sets", built.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]))
        self.sets = built if self.sets is None else self.sets.unionByName(built)

    def try_pairs(self, name: str, pairs: DataFrame, sigs: DataFrame) -> bool:
        """Confirm those of ``pairs(a, b)`` that are links; whether there are any."""
        keep = self.work.keep
        pairs = keep(f"{name}_pairs", pairs if self.tried is None else pairs.join(self.tried, ["a", "b"], "left_anti"))
        self.tried = pairs if self.tried is None else self.tried.unionByName(pairs)
        likely = (
            pairs.join(sigs.select(F.col("node").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sigs.select(F.col("node").alias("b"), F.col("sig").alias("sig_b")), "b")
            .where(F.pandas_udf(_agreement, "int")("sig_a", "sig_b") >= least_agreement(self.percent))
        )
        likely = keep(f"{name}_likely", likely.select("a", "b"))
        if likely.isEmpty():
            return False
        self.build_sets(name, likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct())
        left = self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
        right = self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
        shared = F.size(F.array_intersect("of_a", "of_b"))
        tested = (
            likely.join(left, "a")
            .join(right, "b")
            .select("a", "b", shared.alias("shared"), (F.size("of_a") + F.size("of_b") - shared).alias("either"))
        )
        links = tested.where(F.col("shared") * 100 >= F.col("either") * self.percent).select("a", "b")
        return self.add(name, keep(f"{name}_links", links))

    def root_of(self, rows: DataFrame, node: str, root: str) -> DataFrame:
        """Rows with the root of a node; a node without links is its own."""
        if self.roots is None:
            return rows.withColumn(root, F.col(node))
        found = self.roots.select(F.col("node").alias(node), F.col("root").alias("_root"))
        return rows.join(found, node, "left").withColumn(root, F.coalesce("_root", node)).drop("_root")

    def add(self, name: str, links: DataFrame) -> bool:
        if links.isEmpty():
            return False
        ends = self.root_of(self.root_of(links, "a", "x"), "b", "y")
        tops = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b")), lambda step, df: self.work.keep(f"{name}_{step}", df))
        if self.roots is None:
            self.roots = tops
        else:
            every = self.roots.unionByName(tops.select("node", F.col("node").alias("root"))).distinct()
            found = every.join(tops.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
            self.roots = self.work.keep(f"{name}_roots", found.select("node", F.coalesce("top", "root").alias("root")))
        return True


def _grouped(docs: DataFrame, shingle: int, percent: int, work: Workspace) -> DataFrame:
    """``near_duplicates`` with the component's ``root``, null for an empty set, and the hash of the row's text.

    The result reads the tables ``prints`` and ``names`` of the workspace.
    """
    bounded_batches(docs.sparkSession)
    keep = work.keep
    text = docs.select("doc_id", F.col("text").cast("string").alias("text"), _text_hash(docs).alias("of_text"))
    kind = text.schema["doc_id"].dataType.simpleString()
    prints = keep(
        "prints",
        text.mapInArrow(
            _prints(shingle, bands_for(percent), BAND_ROWS),
            f"doc_id {kind}, n_shingles long, node long, bands array<long>, sig binary, of_text long",
        ),
    )
    filled = prints.where("n_shingles > 0")
    lows = keep("lows", filled.groupBy("node").agg(F.min("doc_id").alias("low")))
    links = _Links(text, filled, lows, shingle, percent, work)
    rows = filled.select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("bucket"))
    stars = rows.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("first"), F.max("node").alias("last"))
    stars = stars.where("first.node <> last").select("bucket", F.col("first.node").alias("center"), F.col("first.n").alias("center_n"))
    members = keep("members", rows.join(keep("stars", stars), "bucket").distinct())
    sigs = keep("sigs", links.first_copies(members.select("node").distinct(), "sig"))

    for turn in range(STAR_ROUNDS):
        able = members.where(f"node <> center and least(n, center_n) * 100 >= greatest(n, center_n) * {percent}")
        able = able.select(F.col("center").alias("a"), F.col("node").alias("b"))
        if turn:
            able = links.root_of(links.root_of(able, "a", "x"), "b", "y").where("x <> y").select("a", "b")
            able = able.join(links.tried, ["a", "b"], "left_anti")
        # A set is in as many buckets as there are bands at most, so its group is small.
        if not links.try_pairs(f"star{turn}", able.groupBy("b").agg(F.mode("a", True).alias("a")).select("a", "b"), sigs):
            break

    labelled = keep("labelled", links.root_of(members.select("bucket", "node", "n"), "node", "root"))
    spread = labelled.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("rows"))
    mixed = keep("mixed", spread.where("low <> high").select("bucket", "rows"))
    few = keep("few", labelled.join(mixed.where(F.col("rows") <= JOIN_UP_TO), "bucket").drop("rows"))
    alike = f"least(x.n, y.n) * 100 >= greatest(x.n, y.n) * {percent}"
    across = few.alias("x").join(few.alias("y"), F.expr(f"x.bucket = y.bucket and x.node < y.node and x.root <> y.root and {alike}"))
    links.try_pairs("across", across.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct(), sigs)
    many = mixed.where(F.col("rows") > JOIN_UP_TO)
    if not many.isEmpty():
        open_rows = keep("open", links.root_of(labelled.join(many, "bucket").drop("root"), "node", "root"))
        nodes = keep("open_nodes", open_rows.select("node").distinct())
        links.build_sets("open", nodes)
        of_open = keep("of_open", links.first_copies(nodes, "sig", "bands").join(links.sets, "node"))
        blocks = _blocks(open_rows.join(of_open, "node")).groupBy("bucket", "low", "high")
        links.add("block", keep("block_links", blocks.applyInPandas(_spanning(percent), "a long, b long").distinct()))

    of_node = keep("of_node", links.root_of(lows, "node", "root"))
    of_root = keep("of_root", of_node.groupBy("root").agg(F.min("low").alias("component_id")))
    names = keep("names", of_node.join(of_root, "root").select("node", "component_id", "root"))
    grouped = filled.select("doc_id", "n_shingles", "of_text", "node").join(names, "node").drop("node")
    # The empty set is nobody's copy.
    alone = prints.where("n_shingles = 0").select(
        "doc_id", "n_shingles", "of_text", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root")
    )
    return grouped.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def without_duplicates(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``docs`` with one row of every group: the one with the smallest ``doc_id``.

    A row is dropped by its id and text, so others of that id stay. Where different texts of a group share the
    smallest id, the one with the smallest hash stays. Rows without ``doc_id`` stay. Of rows equal in ``doc_id`` and
    text one stays; only ids that repeat are compared.
    """
    work = Workspace(docs.sparkSession, "near-dedup")
    found = _grouped(docs, shingle, percent, work)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    keep = work.keep
    found = keep("found", found.where("doc_id is not null").select("doc_id", "of_text", "root", "kept"))
    firsts = found.where("kept and root is not null").groupBy("root").agg(F.min("of_text").alias("first"), F.max("of_text").alias("last"))
    firsts = keep("firsts", firsts.where("first <> last").select("root", "first"))
    surplus = found.where("kept").join(firsts, "root").where("of_text <> first")
    dropped = found.where("not kept").select("doc_id", "of_text").union(surplus.select("doc_id", "of_text")).distinct()
    dropped, repeated = keep("dropped", dropped), keep("repeated", repeated)
    work.only("dropped", "repeated")
    same = (docs["doc_id"] == dropped["doc_id"]) & (_text_hash(docs) == dropped["of_text"])
    rest = docs.join(dropped, same, "left_anti").select(docs.columns)
    if repeated.isEmpty():
        return rest
    once = rest.join(repeated, "doc_id", "left_semi").select(docs.columns).dropDuplicates(["doc_id", "text"])
    return rest.join(repeated, "doc_id", "left_anti").select(docs.columns).unionByName(once)
