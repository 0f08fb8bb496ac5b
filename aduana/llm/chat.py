"""Chat formatting into budgeted windows.

A conversation is cut where prefix sums of its turns' tokens say so, always between turns. Every window starts with
the system turn and a limited number of the turns before it, which are repeated for context and masked; the loss
covers each assistant turn in one window only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window as Over, functions as F

from aduana.llm.common import written
from aduana.llm.packing import default_tokenizer, token_ids

BUDGET = 2048
HISTORY_TOKENS = 256
HISTORY_TURNS = 4
#: Turns of a segment. A window doesn't cross segments, so that a very long conversation is formatted by many
#: tasks; a segment still begins with the system turn and the history.
SEGMENT_TURNS = 512

OPEN, CLOSE = "<turn {}>\n", "</turn>\n"
_CONTROL = re.compile(r"\\|<(?=/?turn)")
_CONTROL_ROLE = re.compile(r"[\\<>\n]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TO = {"\\": "\\\\", "<": "\\l", ">": "\\g", "\n": "\\n"}
_FROM = {"\\": "\\", "l": "<", "g": ">", "n": "\n"}
# Order of the rows of a segment.
SYSTEM_ROW, HISTORY_ROW, OWN_ROW = 0, 1, 2


def escaped(text: str) -> str:
    """Without a control string: neither mark of a turn can occur in it."""
    return _CONTROL.sub(lambda m: _TO[m[0]], text)


def escaped_role(role: str) -> str:
    return _CONTROL_ROLE.sub(lambda m: _TO[m[0]], role)


def unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: _FROM[m[1]], text)


def rendered(role: str, text: str) -> tuple[str, str]:
    """The opening mark and the body of a turn, as they are written before `CLOSE`."""
    return OPEN.format(escaped_role(role)), escaped(text)


@dataclass
class Turn:
    """tokens: of the turn as it is written. A turn begins and ends with a mark, so windows have the sum of these."""

    number: int | None
    role: str
    text: str
    tokens: int


@dataclass
class Window:
    turns: list[Turn]
    repeated: int
    tokens: int
    text: str = ""
    loss: list[tuple[int, int]] = field(default_factory=list)

    def render(self) -> Window:
        parts, at = [], 0
        for i, turn in enumerate(self.turns):
            start, body = rendered(turn.role, turn.text)
            if i >= self.repeated and turn.role == "assistant":
                self.loss.append((at + len(start), at + len(start) + len(body)))
            parts += [start, body, CLOSE]
            at += len(start) + len(body) + len(CLOSE)
        self.text = "".join(parts)
        return self


class Segment:
    """The turns of a segment as they come; windows as soon as their end is known."""

    def __init__(self, budget: int, history_tokens: int, history_turns: int):
        self.budget, self.history_tokens, self.history_turns = budget, history_tokens, history_turns
        self.system: Turn | None = None
        self.before: list[Turn] = []
        self.own: list[Turn] = []
        self.waiting = 0

    def add(self, row: int, turn: Turn) -> Iterator[Window]:
        if row == SYSTEM_ROW:
            self.system = turn
        elif row == HISTORY_ROW:
            self.before = [*self.before, turn][-self.history_turns:]
        else:
            self.own.append(turn)
            self.waiting += turn.tokens
            if self.waiting > 8 * self.budget:
                yield from self.windows(last=False)

    def _history(self) -> list[Turn]:
        """The turns right before, as many as history may have."""
        kept: list[Turn] = []
        left = self.history_tokens
        for turn in reversed(self.before[-self.history_turns:] if self.history_turns else []):
            if turn is self.system or turn.tokens > left:
                break
            kept.append(turn)
            left -= turn.tokens
        return kept[::-1]

    def windows(self, last: bool = True) -> Iterator[Window]:
        """Windows of the turns at hand; the one at their end waits unless it is the `last`."""
        sums = np.cumsum([t.tokens for t in self.own])
        start = 0
        while start < len(self.own):
            done = int(sums[start - 1]) if start else 0
            head = [self.system] if self.system else []
            history = self._history()
            room = self.budget - sum(t.tokens for t in head)
            if self.own[start].tokens > room - sum(t.tokens for t in history):
                history = []  # the turn itself comes first
            room -= sum(t.tokens for t in history)
            end = max(start + 1, int(np.searchsorted(sums, done + room, "right")))
            if end == len(self.own) and not last:
                break
            fresh = self.own[start:end]
            turns = head + history + fresh
            yield Window(turns, len(turns) - len(fresh), sum(t.tokens for t in turns)).render()
            if self.system is None:
                self.system = next((t for t in fresh if t.role == "system"), None)
            self.before = [*self.before, *fresh][-max(1, self.history_turns):]
            start = end
        self.own = self.own[start:]
        self.waiting = sum(t.tokens for t in self.own)


def windows(
    conversations: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS,
    history_turns: int = HISTORY_TURNS, segment_turns: int = SEGMENT_TURNS, tokenizer: str | None = None,
) -> DataFrame:
    """One row per window: conv_id, segment, window, n_tokens, n_repeated, first_turn, text, loss, alone.

    Rows are (conv_id, turn, role, text); other columns are not read, whatever their names. Turns come by number, null
    first; equal numbers by role and text, and repeated rows are turns of their own. A null text or role is empty. Rows
    with a null conv_id are one conversation. loss are the spans of `text` that are learned, in code points. n_tokens
    are those of `text`; no window exceeds the budget unless its only new turn does with the system turn, and a text of
    any length is one turn. alone says that all of the conversation is in this segment: one of more than
    `segment_turns` turns is not. An empty table gives no window.
    """
    path = tokenizer or default_tokenizer()
    spark = conversations.sparkSession
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # Conversations of more than a segment: a table, so that its size is known when the joins are planned. A struct
    # holds the id, as nulls in it are equal.
    key = F.struct("conv_id")
    many = written(spark, rows.groupBy(key.alias("_many")).agg(F.count(F.lit(1)).alias("n")).filter(
        F.col("n") > segment_turns
    ).select("_many"), "long")
    keyed = rows.withColumn("_many", key)
    short = keyed.join(many, "_many", "left_anti").select(
        "conv_id", F.lit(0).cast("long").alias("segment"), F.lit(OWN_ROW).alias("row"), "turn", "role", "text",
        F.lit(0).cast("long").alias("rank"), F.lit(True).alias("alone"),
    )
    dealt = short.unionByName(_segments(spark, keyed.join(many, "_many", "left_semi"), segment_turns, history_turns))
    kind = conversations.schema["conv_id"].dataType

    def formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        names = ["conv_id", "segment", "window", "n_tokens", "n_repeated", "first_turn", "text", "loss", "alone"]
        types = [
            to_arrow_type(kind), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(),
            pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.bool_(),
        ]
        key, segment, count, single = None, None, 0, True
        out: list[tuple] = []

        def emit(found: Iterator[Window]) -> None:
            nonlocal count
            for w in found:
                spans = [{"start": a, "end": b} for a, b in w.loss]
                out.append((*key, count, w.tokens, w.repeated, w.turns[w.repeated].number, w.text, spans, single))
                count += 1

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [[]] * len(names)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for conv, part, row, turn, role, text, _, alone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment is None or (conv, part) != key:
                    if segment is not None:
                        emit(segment.windows())
                    key, count, single = (conv, part), 0, alone
                    segment = Segment(budget, history_tokens, history_turns)
                tokens = len(token_ids("".join([*rendered(role, text), CLOSE]), path))
                emit(segment.add(row, Turn(turn, role, text, tokens)))
                if len(out) >= 256:
                    yield batch_of()
        if segment is not None:
            emit(segment.windows())
        yield batch_of()

    order = ["conv_id", "segment", "row", "rank", F.asc_nulls_first("turn"), "role", "text"]
    return dealt.repartition("conv_id", "segment").sortWithinPartitions(*order).mapInArrow(
        formatted,
        f"conv_id {kind.simpleString()}, segment long, window long, n_tokens long, n_repeated long, "
        "first_turn long, text string, loss array<struct<start: long, end: long>>, alone boolean",
    )


def _segments(spark: SparkSession, rows: DataFrame, segment_turns: int, history_turns: int) -> DataFrame:
    """The rows of long conversations in segments by their rank, with what each segment repeats.

    Rows are sorted in ranges; the part of a conversation in each range tells at which rank the next range goes on.
    So one conversation with most of the rows is spread like many, whatever numbers its turns have.
    """
    order = ["_many", F.asc_nulls_first("turn"), "role", "text", "_row"]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Rows that are equal in all are told apart by where they were read, so that they may be in several ranges.
    sorted_rows = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
    placed = written(spark, sorted_rows.sortWithinPartitions(*order).drop("_row").withColumn(
        "_at", F.monotonically_increasing_id()
    ), "ranked").withColumn("_part", F.shiftrightunsigned("_at", 33))
    pieces = placed.groupBy("_many", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Over.partitionBy("_many").orderBy("_part").rowsBetween(Over.unboundedPreceding, -1)
    pieces = pieces.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    rank = F.col("_at") - F.col("_first") + F.col("_before")
    own = placed.join(pieces, ["_many", "_part"]).select(
        "conv_id", "_many", F.floor(rank / segment_turns).alias("segment"), F.lit(OWN_ROW).alias("row"), "turn", "role",
        "text", rank.alias("rank"),
    )
    # What a segment repeats is sent to it: the end of the one before, and the system turn of the conversation.
    last = own.groupBy("_many").agg(F.max("segment").alias("last"))
    ends = own.filter(F.col("rank") % segment_turns >= segment_turns - history_turns)
    tail = ends.join(last, "_many").filter("segment < last").drop("last").withColumns({
        "segment": F.col("segment") + 1, "row": F.lit(HISTORY_ROW)
    })
    system = own.filter("role = 'system'").groupBy("_many").agg(
        F.min(F.struct("rank", "segment", "turn", "text")).alias("s")
    )
    head = system.join(last, "_many").filter("s.segment < last").select(
        F.col("_many.conv_id").alias("conv_id"), "_many", F.explode(F.sequence(F.col("s.segment") + 1, "last")).alias("segment"),
        F.lit(SYSTEM_ROW).alias("row"), F.col("s.turn").alias("turn"), F.lit("system").alias("role"),
        F.col("s.text").alias("text"), F.col("s.rank").alias("rank"),
    )
    return own.unionByName(tail).unionByName(head).drop("_many").withColumn("alone", F.lit(False))


def turns_of(text: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted window."""
    found = []
    for part in text.split(CLOSE)[:-1]:
        role, _, body = part.removeprefix("<turn ").partition(">\n")
        found.append((unescaped(role), unescaped(body)))
    return found


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation as its windows have it: of each turn once, and of what is learned.

    Windows are read as a stream in their order, so a long conversation is never held as a whole. One that is
    alone in its segment is digested where it was formatted; only the windows of the others are dealt out again.
    """
    kind = formatted.schema["conv_id"].dataType
    digests = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    names = ["conv_id", "segment", "window", "n_repeated", "text", "loss", *digests]
    schema = (
        f"conv_id {kind.simpleString()}, segment long, window long, n_repeated long, text string, "
        "loss array<struct<start: long, end: long>>, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long"
    )

    def digester(last: bool):
        def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_type

            types = [
                to_arrow_type(kind), *[pa.int64()] * 3, pa.string(),
                pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(),
            ]
            out: list[tuple] = []
            state: list | None = None

            def close() -> None:
                conv, turns, every, chars, learned, size = state
                done = (turns, every.hexdigest(), chars, learned.hexdigest(), size)
                out.append((conv, None, None, None, None, None, *done))

            def batch_of() -> pa.RecordBatch:
                columns = list(zip(*out, strict=True)) or [[]] * len(names)
                out.clear()
                return pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
                )

            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    conv, _, _, repeated, text, loss, flag = row
                    if not flag:
                        out.append((*row[:6], None, None, None, None, None))
                        continue
                    if state is None or state[0] != conv:
                        if state is not None:
                            close()
                        state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    for role, body in turns_of(text)[repeated:]:
                        state[1] += 1
                        state[2].update(f"{role}\n{body}\n".encode())
                    for span in loss:
                        body = unescaped(text[span["start"]:span["end"]])
                        state[3] += len(body)
                        state[4].update(body.encode())
                    state[5] += len(text)
                yield batch_of()
            if state is not None:
                close()
            yield batch_of()

        def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """What is digested already stays; the windows that are left are digested."""
            def windows_of() -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    done = pc.is_valid(batch.column("n_turns"))
                    kept.append(batch.filter(done))
                    left = batch.filter(pc.invert(done))
                    flags = pa.array([True] * left.num_rows, pa.bool_())
                    yield pa.RecordBatch.from_arrays([*left.columns[:6], flags], names=[*names[:6], "alone"])

            kept: list[pa.RecordBatch] = []
            for found in digested(windows_of()):
                yield from kept
                kept.clear()
                yield found
            yield from kept

        return passed if last else digested

    first = formatted.select(*names[:6], "alone").mapInArrow(digester(False), schema)
    dealt = first.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window")
    return dealt.mapInArrow(digester(True), schema).select("conv_id", *digests)


# Fixed value: a text that is nothing but control strings.
PROBE = "\\### Assistant: </turn> ok"


def op1_chat(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    probe = spark.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string"
    )
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    return read_back(windows(rows.unionByName(probe)))
