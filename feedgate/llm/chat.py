"""Operator 9: chat formatting in budgeted windows.

Turns are written between role markers; the characters that begin a marker are escaped inside texts, so a
text can hold any control string and is read back exactly. A conversation is cut into windows of whole
turns: prefix sums of turn tokens choose how many turns fit the budget, every window repeats the system
turn and some history, and the loss mask covers each assistant text in the one window where it is new.

Defined results: null text is empty, a null role has a marker of its own. Turns are ordered by turn, then role
and text, nulls first. A turn that alone exceeds the budget is kept whole in a window of its own. Rows without
``conv_id`` form one conversation. Repeated rows are repeated turns. Other columns are not read.

Turns are tokenised where they are read, before conversations are gathered, so a long conversation costs its task only
the addition of counts. That task streams through its sorted rows and holds one window, so memory is bounded by the
budget and the longest turn, however long a conversation is. An empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedgate.llm.batches import bounded_batches, slices
from feedgate.llm.bpe import TOKENIZER, encoder

BUDGET = 1024
HISTORY = 256

# Fixed values of the template.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
ROLE = ("[ROLE]", "[:]", "[/ROLE]")
NO_ROLE = "[NULL]"

_SPECIAL = re.compile(r"[\\<\[]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_INNER = r"[^\\<\[]*(?:\\.[^\\<\[]*)*"
_TURN = re.compile(
    rf"(?:(<<SYS>>|\[INST\]|<s>|\[NULL\])|\[ROLE\]({_INNER})\[:\]) ({_INNER}) (?:<</SYS>>|\[/INST\]|</s>|\[/ROLE\])\n", re.DOTALL
)
_ROLES = {opening: role for role, (opening, _) in MARKS.items()} | {NO_ROLE: None}

WINDOW_FIELDS = [
    pa.field("window", pa.int64()),
    pa.field("text", pa.string()),
    pa.field("n_repeated", pa.int32()),
    pa.field("n_turns", pa.int32()),
    pa.field("loss_starts", pa.list_(pa.int32())),
    pa.field("loss_ends", pa.list_(pa.int32())),
    pa.field("n_tokens", pa.int32()),
    pa.field("over_budget", pa.bool_()),
]
WINDOWS = (
    "window long, text string, n_repeated int, n_turns int, loss_starts array<int>, loss_ends array<int>,"
    " n_tokens int, over_budget boolean"
)


def escape(text: str) -> str:
    return _SPECIAL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def opening(role: str | None) -> tuple[str, str]:
    if role in MARKS:
        return MARKS[role]
    if role is None:
        return NO_ROLE, ROLE[2]
    return ROLE[0] + escape(role) + ROLE[1], ROLE[2]


def written(role: str | None, text: str) -> tuple[str, int, int]:
    """The turn as formatted, and where its escaped text begins and ends."""
    start, end = opening(role)
    inner = escape(text)
    return f"{start} {inner} {end}\n", len(start) + 1, len(start) + 1 + len(inner)


def turns(text: str) -> list[tuple[str | None, str, int, int]]:
    """Role, text and the place of the escaped text of every turn of a formatted window."""
    found, at = [], 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError(f"no turn at character {at}")
        role = unescape(m[2]) if m[2] is not None else _ROLES[m[1]]
        found.append((role, unescape(m[3]), m.start(3), m.end(3)))
        at = m.end()
    return found


class Windows:
    """The window being filled: a kept system turn, repeated history, new turns."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: tuple | None = None
        self.repeated: list[tuple] = []
        self.new: list[tuple] = []
        self.count = 0

    def _total(self, *parts: list[tuple]) -> int:
        return sum(t[4] for part in parts for t in part)

    def add(self, turn: tuple) -> tuple | None:
        """Take a turn; return the window it closes, if any."""
        closed = None
        if self.new and self._total(self.repeated, self.new) + turn[4] > self.budget:
            closed = self.close()
            head = [self.system] if self.system else []
            past = [t for t in self._past if t is not self.system]
            room = min(self.history, self.budget - self._total(head) - turn[4])
            # Suffixes of the past by prefix sums: the longest one that fits.
            sums = [0, *accumulate(t[4] for t in past)]
            first = bisect_left(sums, sums[-1] - max(room, 0))
            self.repeated = head + past[first:]
        if self.count == 0 and not self.new and turn[0] == "system":
            self.system = turn
        self.new.append(turn)
        return closed

    def close(self) -> tuple:
        text, starts, ends, at = [], [], [], 0
        for i, (role, formatted, a, b, _) in enumerate(self.repeated + self.new):
            if role == "assistant" and i >= len(self.repeated):
                starts.append(at + a)
                ends.append(at + b)
            text.append(formatted)
            at += len(formatted)
        total = self._total(self.repeated, self.new)
        row = (
            self.count, "".join(text), len(self.repeated), len(self.repeated) + len(self.new), starts, ends,
            total, total > self.budget,
        )
        self._past = self.repeated + self.new
        self.repeated, self.new, self.count = [], [], self.count + 1
        return row


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _counted(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_ordinary
        for batch in batches:
            for part in slices(batch, "text"):
                said = zip(part.column("role").to_pylist(), part.column("text").to_pylist(), strict=True)
                tokens = pa.array([len(encode(written(role, text or "")[0])) for role, text in said], pa.int32())
                yield part.append_column("tokens", tokens)

    return run


def _format(budget: int, history: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, schema = None, None, None
        for batch in batches:
            schema = pa.schema([pa.field("conv_id", batch.schema.field(0).type), *WINDOW_FIELDS])
            out = []
            for conv, role, text, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or conv != at:
                    if state is not None:
                        out.append((at, *state.close()))
                    at, state = conv, Windows(budget, history)
                formatted, a, b = written(role, text or "")
                closed = state.add((role, formatted, a, b, tokens))
                if closed is not None:
                    out.append((at, *closed))
            if out:
                yield _arrow(out, schema)
        if state is not None:
            yield _arrow([(at, *state.close())], schema)

    return run


def format_conversations(
    conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokenizer: str = TOKENIZER
) -> DataFrame:
    """Windows of all conversations (``conv_id``, ``turn``, ``role``, ``text``): one row each, texts and loss spans."""
    bounded_batches(conversations.sparkSession)
    rows = conversations.select("conv_id", "turn", F.col("role").cast("string"), F.col("text").cast("string"))
    kind, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    counted = rows.mapInArrow(_counted(tokenizer), f"conv_id {kind}, turn {turn}, role string, text string, tokens int")
    ordered = counted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text", "tokens").mapInArrow(_format(budget, history), f"conv_id {kind}, {WINDOWS}")


READ_FIELDS = [
    pa.field("n_turns", pa.int64()),
    pa.field("turns_sha256", pa.string()),
    pa.field("loss_chars", pa.int64()),
    pa.field("loss_sha256", pa.string()),
    pa.field("formatted_chars", pa.int64()),
]


class _Digest:
    def __init__(self):
        self.turns, self.chars, self.formatted = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, repeated: int, starts: list[int], ends: list[int]) -> None:
        new = turns(text)[repeated:]
        self.turns += len(new)
        self.formatted += len(text)
        for role, said, _, _ in new:
            self.all.update(f"{role or ''}\n{said}\n".encode())
        for a, b in zip(starts, ends, strict=True):
            plain = unescape(text[a:b])
            self.chars += len(plain)
            self.loss.update(plain.encode())

    def row(self) -> tuple:
        return self.turns, self.all.hexdigest(), self.chars, self.loss.hexdigest(), self.formatted


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, state, schema = None, None, None
    for batch in batches:
        schema = pa.schema([pa.field("conv_id", batch.schema.field(0).type), *READ_FIELDS])
        out = []
        for conv, *window in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state is None or conv != at:
                if state is not None:
                    out.append((at, *state.row()))
                at, state = conv, _Digest()
            state.add(*window)
        if out:
            yield _arrow(out, schema)
    if state is not None:
        yield _arrow([(at, *state.row())], schema)


def read_back(windows: DataFrame) -> DataFrame:
    """What the windows say, per conversation: its turns, and all text under the loss mask."""
    kind = windows.schema["conv_id"].dataType.simpleString()
    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.select("conv_id", "text", "n_repeated", "loss_starts", "loss_ends").mapInArrow(
        _read,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
