"""Operator 13: repair of conversations by aligning their turns with an alternating grammar.

The roles of a repaired conversation read ``(s?(ua)+)?`` in initials. A row may be kept (0), given the role user or
assistant (2) or deleted (3); blank rows and repeats of an earlier row must go; an empty user or assistant row may be
inserted (2); every truncated row that stays costs 1. The cheapest edits win, and of those the audit (their initials
D, I, K, R in order) that is least in ASCII.

Method: Wagner-Fischer alignment of the rows with the grammar's string of each feasible length, nearest lengths first.
A table only spans the diagonals that the cost of the best repair so far allows (Ukkonen), and lengths that cannot
reach that cost are not tried. Of equally cheap lengths the backtraced audits are compared.

Rows are put in order by a range partitioning, which spreads a conversation over tasks, and written. A conversation is
aligned in blocks: first the least cost between every two states of the grammar at the ends of a block,
then, from the end, the cost to go behind each block, then the alignment of each block for every state it may begin in,
and last a walk that picks the state. In a block no insert follows its last row, so no audit begins another one and
the least audits of blocks join to the least audit of the whole. A short conversation, the usual case, is aligned at once. The two scans over the blocks of one conversation run in one task with constant memory.

Defined results: rows are ordered by turn (nulls first), role and the text's md5; a null role or text counts as empty.
A row is blank if its text has nothing but ASCII white space; else a repeat, if role and text (by md5) occurred
earlier; else truncated, if its last character other than white space is none of ``.!?``. A role that begins with none
of s, u, a cannot be kept. Null conversation ids are one conversation. Only the four named columns are read, so others
may have any name. An empty table gives empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedgate.llm.batches import bounded_batches
from feedgate.plans.workspace import Workspace

# A conversation of up to WHOLE rows is aligned at once, a longer one in blocks of BLOCK rows.
WHOLE = 16
BLOCK = 8
DELETE, REROLE, INSERT, TRUNCATED = 3, 2, 2, 1
NEVER = 1 << 40
ROLES = {"s": "system", "u": "user", "a": "assistant"}
SPACE = " \t\n\x0b\f\r"

# States of the grammar: nothing yet, after s, after u, after a.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
# What must still be inserted in each state at the end, and its cost.
TAILS = ("", "II", "I", "")
TO_END = tuple(INSERT * len(tail) for tail in TAILS)
# The states that inserts alone lead to, and how many it takes.
REACHED = (
    {NOTHING: 0, USER: 1, ASSISTANT: 2},
    {SYSTEM: 0, USER: 1, ASSISTANT: 2},
    {USER: 0, ASSISTANT: 1},
    {ASSISTANT: 0, USER: 1},
)


def targets(state: int, length: int) -> list[str]:
    """The grammar's strings of one length from a state on."""
    if state == USER:
        return [("au" * length)[:length]]
    plain = [("ua" * length)[:length]]
    return plain + ["s" + ("ua" * length)[: length - 1]] if state == NOTHING and length else plain


def _end(state: int, target: str) -> int:
    return AFTER[target[-1]] if target else state


def _stay(row: str, symbol: str) -> int:
    """The cost of a row (initial and fault: o none, t truncated, x must go) in the place of a symbol."""
    if row[1] == "x" or (symbol == "s" and row[0] != "s"):
        return NEVER
    return (0 if row[0] == symbol else REROLE) + (TRUNCATED if row[1] == "t" else 0)


def _first_cost(rows: list[str], state: int, to_go: tuple[int, ...]) -> int:
    """The cost of some repair, found without a table; NEVER if there is none.

    Either nothing is deleted or inserted that need not be, or all rows go and what leads to an end state is inserted,
    or only one system row stays.
    """
    all_gone = DELETE * len(rows)
    costs = [all_gone + INSERT * steps + to_go[end] for end, steps in REACHED[state].items()]
    systems = [_stay(row, "s") for row in rows] if state == NOTHING else []
    costs.append(min(systems, default=NEVER) + all_gone - DELETE + to_go[SYSTEM])
    cost = 0
    for row in rows:
        symbol = "a" if state == USER else "s" if state == NOTHING and row[0] == "s" else "u"
        stay = _stay(row, symbol)
        if stay < NEVER:
            state = AFTER[symbol]
        cost += min(stay, DELETE)
    return min(NEVER, cost + to_go[state], *costs)


def _aligned(rows: list[str], target: str, rest: int, budget: int) -> tuple[int, str]:
    """Cost and least audit of rows against a target with ``rest`` to pay behind it; (NEVER, '') beyond the budget."""
    n, m = len(rows), len(target)
    deletes = (budget - rest + INSERT * (n - m)) // (DELETE + INSERT)
    inserts = deletes - (n - m)
    if deletes < max(0, n - m) or inserts < 0:
        return NEVER, ""
    least = [[NEVER] * (m + 2) for _ in range(n + 1)]
    least[n][m] = rest
    insert = [NEVER if symbol == "s" else INSERT for symbol in target]
    for i in range(n - 1, -1, -1):
        row, below, own = rows[i], least[i + 1], least[i]
        for j in range(min(m, i + inserts), max(0, i - deletes) - 1, -1):
            best = DELETE + below[j]
            if j < m:
                best = min(best, _stay(row, target[j]) + below[j + 1], insert[j] + own[j + 1])
            own[j] = best
    cost = least[0][0]
    if cost > budget:
        return NEVER, ""
    audit, i, j = [], 0, 0
    while i < n:
        now = least[i][j]
        if DELETE + least[i + 1][j] == now:
            audit.append("D")
            i += 1
        elif j < m and insert[j] + least[i][j + 1] == now:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if rows[i][0] == target[j] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


@lru_cache(maxsize=100_000)
def repaired(codes: str, state: int, to_go: tuple[int, ...]) -> tuple[int, str, int]:
    """Cost, least audit and end state of a block (two characters a row) from ``state``, with ``to_go`` behind each end state."""
    rows = [codes[i : i + 2] for i in range(0, len(codes), 2)]
    budget, audit, end = _first_cost(rows, state, to_go), None, state
    if budget >= NEVER:
        return NEVER, "", state
    alive = sum(row[1] != "x" for row in rows)
    gone = DELETE * (len(rows) - alive) + min(to_go)

    def bound(length: int) -> int:
        return gone + max(DELETE * (alive - length), INSERT * (length - alive))

    shorter, longer = alive, alive + 1
    while True:
        length = shorter if shorter >= 0 and bound(shorter) <= bound(longer) else longer
        if bound(length) > budget:
            break
        shorter, longer = (shorter - 1, longer) if length == shorter else (shorter, longer + 1)
        for target in targets(state, length):
            last = _end(state, target)
            if to_go[last] < NEVER:
                cost, found = _aligned(rows, target, to_go[last], budget)
                if cost < budget or (cost == budget and (audit is None or found < audit)):
                    budget, audit, end = cost, found, last
    return budget, audit, end


def illegal_pairs(codes: str) -> int:
    """Neighbours whose initials are none of su, ua, au."""
    roles = codes[::2]
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(roles[:-1], roles[1:], strict=True)))


def between_states(codes: str) -> list[int]:
    """The least cost of a block from each state to each state, row by row."""
    ends = [tuple(0 if end == other else NEVER for other in range(4)) for end in range(4)]
    return [repaired(codes, state, end)[0] for state in range(4) for end in ends]


def edits_of(codes: str, places: list[int], audit: str, state: int) -> list[dict]:
    """One entry for each edit: the row it is at, its order there, its initial and the role it gives."""
    out, i, step = [], 0, 0
    for edit in audit:
        symbol = "a" if state == USER else "u"
        if edit == "K":
            symbol = codes[2 * i]
        at = min(i, len(places) - 1)
        out.append({"at": places[at], "step": step, "edit": edit, "role": ROLES[symbol] if edit in "IR" else None})
        state = state if edit == "D" else AFTER[symbol]
        # Inserts behind the last row come after it.
        i, step = (i + 1, 0 if i + 1 < len(places) else step + 1) if edit != "I" else (i, step + 1)
    return out


EDIT = pa.struct([("at", pa.int64()), ("step", pa.int32()), ("edit", pa.string()), ("role", pa.string())])
EDITS = "array<struct<at:long,step:int,edit:string,role:string>>"
LONGS = pa.list_(pa.int64())


def _mapped(fields: list[tuple[str, pa.DataType]], per_row, fresh=None):
    """A function for mapInArrow: ``conv_id`` and what ``per_row`` makes of a row; ``fresh`` makes the state of a scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = fresh() if fresh else None
        for batch in batches:
            made = [per_row(row, state) if fresh else per_row(row) for row in batch.to_pylist()]
            arrays = [pa.array([row[i] for row in made], kind) for i, (_, kind) in enumerate(fields)]
            names = [name for name, _ in fields]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [batch.schema.names[0], *names])

    return run


def _alone(row: dict) -> tuple:
    cost, audit, end = repaired(row["codes"], NOTHING, TO_END)
    return cost, illegal_pairs(row["codes"]), edits_of(row["codes"], row["places"], audit + TAILS[end], NOTHING)


class _Scan:
    """What a scan over ordered blocks remembers of the conversation it is in."""

    def __init__(self):
        self.conv, self.begun, self.to_go, self.next, self.state = None, False, TO_END, None, NOTHING

    def enters(self, conv) -> bool:
        new = not self.begun or conv != self.conv
        self.conv, self.begun = conv, True
        return new


def _to_go(row: dict, scan: _Scan) -> tuple:
    """From the last block to the first: the cost to go behind the block, and the cost were it the first."""
    last = scan.enters(row["conv_id"])
    if last:
        scan.to_go, scan.next = TO_END, None
    behind, codes = scan.to_go, row["codes"]
    step = [row["least"][4 * state : 4 * state + 4] for state in range(4)]
    scan.to_go = tuple(min(NEVER, *(a + b for a, b in zip(costs, behind, strict=True))) for costs in step)
    illegal = illegal_pairs(codes) + (illegal_pairs(codes[-2:] + scan.next) if scan.next else 0)
    scan.next = codes[:2]
    return row["part"], row["block"], codes, row["places"], list(behind), last, scan.to_go[NOTHING], illegal


def _choices(row: dict) -> tuple:
    """The best audit of a block for each state it may begin in, and the state it ends in."""
    found = [repaired(row["codes"], state, tuple(row["behind"])) for state in range(4)]
    audits = [audit + (TAILS[end] if row["last"] else "") for _, audit, end in found]
    return row["part"], row["block"], row["codes"], row["places"], audits, [end for _, _, end in found]


def _walk(row: dict, scan: _Scan) -> tuple:
    """From the first block to the last: the edits of the block in the state that the blocks before it end in."""
    if scan.enters(row["conv_id"]):
        scan.state = NOTHING
    edits = edits_of(row["codes"], row["places"], row["audits"][scan.state], scan.state)
    scan.state = row["ends"][scan.state]
    return (edits,)


BLOCK_FIELDS = [("part", pa.int64()), ("block", pa.int64()), ("codes", pa.string()), ("places", LONGS)]
BLOCK_DDL = "part long, block long, codes string, places array<long>"


def _ordered(conversations: DataFrame) -> DataFrame:
    """Rows in order: ``at`` grows with the order, its high bits are the partition."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    body = F.rtrim(text, F.lit(SPACE))
    initial = F.substring(role, 1, 1)
    rows = conversations.select(
        "conv_id",
        "turn",
        role.alias("role"),
        text.alias("text"),
        F.unhex(F.md5(text.cast("binary"))).alias("digest"),
        F.when(initial.isin(*ROLES), initial).otherwise("-").alias("initial"),
        (body == "").alias("blank"),
        F.right(body, F.lit(1)).isin(".", "!", "?").alias("closed"),
        F.monotonically_increasing_id().alias("arrival"),
    )
    order = ["conv_id", "turn", "role", "digest", "arrival"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return rows.withColumn("at", F.monotonically_increasing_id()).drop("arrival")


def _same(one: DataFrame, two: DataFrame, *columns: str):
    matched = [one[c].eqNullSafe(two[c]) for c in columns]
    return matched[0] if len(matched) == 1 else matched[0] & matched[1]


def repair_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edits of all conversations ``(conv_id, turn, role, text)``, and one row about each conversation.

    Edits: ``conv_id, at, step, edit, fault, turn, role, text``; ``at`` and ``step`` order them, and all but edit ``D`` are
    the rows of the repaired conversation. Conversations: ``conv_id, rows, gaps, blank, duplicate, truncated, illegal, cost``.
    """
    spark = conversations.sparkSession
    bounded_batches(spark)
    keep = Workspace(spark, "turn-repair").keep
    turns = keep("turns", _ordered(conversations))
    kind = f"conv_id {turns.schema['conv_id'].dataType.simpleString()}"
    firsts = turns.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = F.expr("case when blank then 'blank' when first is null then 'duplicate' when not closed then 'truncated' end")
    slim = turns.join(keep("firsts", firsts), "at", "left").select(
        "conv_id", "at", F.shiftrightunsigned("at", 33).alias("part"), "turn", "initial", fault.alias("fault")
    )
    slim = keep("slim", slim)
    segments = keep("segments", slim.groupBy("conv_id", "part").agg(F.min("at").alias("begin"), F.count("*").alias("rows")))
    convs = segments.groupBy(F.col("conv_id").alias("of")).agg(F.count("*").alias("segments"), F.max("rows").alias("most"))
    convs = convs.select("of", F.expr(f"segments = 1 and most <= {WHOLE}").alias("alone"))
    segments = segments.join(convs, segments["conv_id"].eqNullSafe(convs["of"])).select(
        F.col("conv_id").alias("of"), F.col("part").alias("of_part"), "begin", "alone"
    )
    code = F.concat("initial", F.expr("case when fault in ('blank', 'duplicate') then 'x' when fault = 'truncated' then 't' else 'o' end"))
    dealt = slim.join(segments, slim["conv_id"].eqNullSafe(segments["of"]) & (slim["part"] == segments["of_part"]))
    blocks = (
        dealt.groupBy("conv_id", "part", F.expr(f"if(alone, 0, (at - begin) div {BLOCK})").alias("block"), "alone")
        .agg(F.array_sort(F.collect_list(F.struct("at", code.alias("code")))).alias("rows"))
        .select("conv_id", "part", "block", F.array_join("rows.code", "").alias("codes"), F.col("rows.at").alias("places"), "alone")
    )
    blocks = keep("blocks", blocks)

    solved = blocks.where("alone").select("conv_id", "codes", "places").mapInArrow(
        _mapped([("cost", pa.int64()), ("illegal", pa.int64()), ("edits", pa.list_(EDIT))], _alone),
        f"{kind}, cost long, illegal long, edits {EDITS}",
    )
    solved = keep("solved", solved)
    costs, edits = solved.select("conv_id", "cost", "illegal"), solved.select("conv_id", "edits")
    many = blocks.where("not alone")
    if not many.isEmpty():
        least = many.select("conv_id", "part", "block", "codes", "places").mapInArrow(
            _mapped([*BLOCK_FIELDS, ("least", LONGS)], lambda r: (r["part"], r["block"], r["codes"], r["places"], between_states(r["codes"]))),
            f"{kind}, {BLOCK_DDL}, least array<long>",
        )
        backwards = least.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("block"))
        behind = backwards.mapInArrow(
            _mapped(
                [*BLOCK_FIELDS, ("behind", LONGS), ("last", pa.bool_()), ("cost", pa.int64()), ("illegal", pa.int64())], _to_go, _Scan
            ),
            f"{kind}, {BLOCK_DDL}, behind array<long>, last boolean, cost long, illegal long",
        )
        behind = keep("behind", behind)
        choices = behind.drop("cost", "illegal").repartition("conv_id", "part", "block").mapInArrow(
            _mapped([*BLOCK_FIELDS, ("audits", pa.list_(pa.string())), ("ends", LONGS)], _choices),
            f"{kind}, {BLOCK_DDL}, audits array<string>, ends array<long>",
        )
        forwards = choices.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
        walked = forwards.mapInArrow(_mapped([("edits", pa.list_(EDIT))], _walk, _Scan), f"{kind}, edits {EDITS}")
        edits = edits.unionByName(keep("walked", walked))
        costs = costs.unionByName(
            behind.groupBy("conv_id").agg(F.expr("min_by(cost, struct(part, block))").alias("cost"), F.sum("illegal").alias("illegal"))
        )

    each = edits.select(F.explode("edits").alias("e")).select("e.*").withColumnsRenamed({"at": "of_at", "role": "gives"})
    source = turns.join(slim.select(F.col("at").alias("slim_at"), "fault"), F.col("at") == F.col("slim_at"))
    inserted = F.col("edit") == "I"
    repaired_rows = each.join(source, each["of_at"] == source["at"]).select(
        "conv_id",
        "at",
        "step",
        "edit",
        F.when(~inserted, F.col("fault")).alias("fault"),
        F.when(~inserted, F.col("turn")).alias("turn"),
        F.coalesce("gives", "role").alias("role"),
        F.when(inserted, F.lit("")).otherwise(F.col("text")).alias("text"),
    )

    counted = slim.groupBy("conv_id").agg(
        F.count("*").alias("rows"),
        F.expr("coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)").cast("long").alias("gaps"),
        *[F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")],
    )
    costs = costs.withColumnRenamed("conv_id", "of")
    found = counted.join(costs, counted["conv_id"].eqNullSafe(costs["of"]))
    return repaired_rows, found.select("conv_id", "rows", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")


class _Digests:
    def __init__(self, conv):
        self.conv, self.audit, self.hash, self.rows = conv, [], hashlib.sha256(), 0

    def add(self, edit: str, role: str, text: str) -> None:
        self.audit.append(edit)
        if edit != "D":
            self.hash.update(f"{chr(10) if self.rows else ''}{role}:{text}".encode())
            self.rows += 1

    def row(self) -> tuple:
        return self.conv, "".join(self.audit), self.hash.hexdigest()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state, kind = None, None
    for batch in batches:
        kind, done = batch.schema.field(0).type, []
        for conv, edit, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state is None or conv != state.conv:
                done += [state.row()] if state else []
                state = _Digests(conv)
            state.add(edit, role, text)
        if done:
            yield _arrow(done, kind)
    if state:
        yield _arrow([state.row()], kind)


def _arrow(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, t) for c, t in zip(columns, (kind, pa.string(), pa.string()), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, ["conv_id", "audit", "repaired_sha256"])


def digest(repaired_rows: DataFrame) -> DataFrame:
    """The audit and the hash of the repaired rows of each conversation. A hash is sequential: one conversation, one task."""
    kind = repaired_rows.schema["conv_id"].dataType.simpleString()
    ordered = repaired_rows.repartition("conv_id").sortWithinPartitions("conv_id", "at", "step")
    return ordered.select("conv_id", "edit", "role", "text").mapInArrow(
        _digested, f"conv_id {kind}, audit string, repaired_sha256 string"
    )


def with_damage(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with rows dropped, emptied, cut, repeated or given another role, as a crc32 of
    ``conv_id:turn`` decides; nulls count as one space."""

    def plain(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), kind.alias("_kind"))
    text = F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return (
        rows.where("_kind <> 0")
        .select("conv_id", "turn", F.when(F.col("_kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("_copies"))
        .withColumn("_copy", F.explode("_copies"))
        .select("conv_id", "turn", "role", "text")
    )


def repair_digest(conversations: DataFrame) -> DataFrame:
    """Damage, repair and digest: a row for every conversation, also one that lost all its rows."""
    edits, found = repair_conversations(with_damage(conversations))
    said = digest(edits).withColumnRenamed("conv_id", "of_said")
    found = found.withColumnRenamed("conv_id", "of_found")
    every = conversations.select("conv_id").distinct()
    every = every.join(found, every["conv_id"].eqNullSafe(found["of_found"]), "left")
    every = every.join(said, every["conv_id"].eqNullSafe(said["of_said"]), "left")
    return every.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
