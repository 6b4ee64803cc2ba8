"""Conversations as training text: a declarative template, a finite-state machine over roles, segments with loss flags.

Turns are sorted once by conversation over ranges of the whole table, so that a conversation with much of the data spreads
over tasks. A range that begins inside a conversation doesn't know the machine's state there: it notes where each possible
state would lead. The few notes, one for each range, are followed up afterwards and give each range its first state.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehaul.llm.components import stored
from tablehaul.llm.frames import in_batches
from tablehaul.llm.textarrays import byte_slices

ROLE, TEXT = "role", "text"


@dataclass(frozen=True)
class Template:
    """What a turn looks like, which roles are learnt, and in which order roles may come.

    ``turn`` lists literal texts and the fields ``("role",)`` and ``("text",)``, the role first; it begins with a control
    string, has one right after the text, and a line break after the role. ``order`` maps a state and a role to the next
    state; state 0 is the begin, and a pair that isn't listed is an error, which stays. ``final`` are the states in which a
    conversation is complete.
    """

    turn: tuple[str | tuple[str], ...] = ("<|im_start|>", (ROLE,), "\n", (TEXT,), "<|im_end|>", "\n")
    learnt: tuple[str, ...] = ("assistant",)
    order: dict[tuple[int, str], int] = field(default_factory=lambda: {
        (0, "system"): 1, (0, "user"): 2, (1, "user"): 2, (2, "assistant"): 3, (3, "user"): 2, (3, "tool"): 4, (4, "tool"): 4,
        (4, "assistant"): 3,
    })
    final: tuple[int, ...] = (3,)

    @property
    def states(self) -> int:
        return 1 + max([0, *self.order.values(), *(s for s, _ in self.order)])

    def step(self, state: int, role: str) -> int:
        """The next state; -1 is the error."""
        return self.order.get((state, role), -1) if state >= 0 else -1


CHAT = Template()
# An opening of a control string, with the backslashes that escape it.
_OPENING = r"<(\\*)\|"


def escaped(text: Column) -> Column:
    """A text without control strings: each ``<|``, however often escaped, gets one backslash more between its signs."""
    return F.regexp_replace(text, _OPENING, r"<$1\\|")


def escaped_role(role: Column) -> Column:
    """Also without line breaks, which end the role."""
    return F.replace(F.replace(escaped(role), F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", lambda m: f"<{m[1]}|", text)


def unescaped_role(role: str) -> str:
    return unescaped(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


SEGMENTS = "array<struct<text: string, loss: boolean>>"
_TURNS = "conv_id bigint, turn bigint, role string, text string, place bigint, range int, states array<int>"


def _followed(rows: DataFrame, template: Template) -> DataFrame:
    """Sorted turns with their place and, for each state the range may begin in, the machine's state after the turn.

    Only the first conversation of a range may have begun before; later ones begin in state 0 and have one state.
    """
    order = ["conv_id", "turn", "role", "text"]

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, now, states = TaskContext.get().partitionId(), 0, None, list(range(template.states)) + [-1]
        first, known = True, []
        for batch in byte_slices(batches, "text"):
            for conv, role in zip(batch.column("conv_id").to_pylist(), batch.column("role").to_pylist()):
                if not first and conv != now:
                    states = [0]
                now, first = conv, False
                states = [template.step(s, role) for s in states]
                known.append(states)
            columns = [batch.column(c) for c in order] + [
                pa.array(np.arange(batch.num_rows) + (part << 40) + place), pa.array(np.full(batch.num_rows, part, np.int32)),
                pa.array(known, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=_NAMES)
            place, known = place + batch.num_rows, []

    sorted_rows = rows.repartitionByRange("conv_id", "turn", "role").sortWithinPartitions(*order)
    return in_batches(sorted_rows).mapInArrow(follow, _TURNS)


_NAMES = [x.split()[0] for x in _TURNS.split(", ")]


def _first_states(turns: DataFrame, template: Template) -> DataFrame:
    """(range, state) for ranges whose first turn continues the conversation that the range before ended with."""
    edges = turns.groupBy("range").agg(
        F.min_by("conv_id", "place").alias("begins"), F.max_by("conv_id", "place").alias("ends"), F.max_by("states", "place").alias("states")
    )

    def follow(table: pa.Table) -> pa.Table:
        ranges, found, state, before = [], [], 0, None
        for row in sorted(table.to_pylist(), key=lambda r: r["range"]):
            # A range without an own begin goes on from where the last one ended; 0 is the begin of a conversation.
            state = state if before is not None and before[0] == row["begins"] else 0
            ranges.append(row["range"])
            found.append(state)
            state = row["states"][state] if len(row["states"]) > 1 else row["states"][0]
            before = (row["ends"],)
        return pa.table([pa.array(ranges, pa.int32()), pa.array(found, pa.int32())], names=["range", "first"])

    # A row for each range: their number is the session's shuffle partitions, not the rows.
    return edges.withColumn("all", F.lit(0)).groupBy("all").applyInArrow(follow, "range int, first int")


def format_conversations(rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """A row for each turn of ``rows`` (conv_id, turn, role, text): its segments, with a loss flag each, and its validity.

    Returns conv_id, turn, place, role, segments (text, loss), state and valid. The texts of all segments of a conversation, by
    place, are its training text; those with ``loss`` are what is learnt: texts of the template's learnt roles. ``state``
    is that of the machine after the turn, -1 after an error; ``valid`` says whether the order was right up to this turn.

    Turns are sorted by turn (null first), of equal turns by role and text. A null role or text counts as empty; an empty
    role is in no order. Rows with a null conv_id are one conversation. Repeated rows are turns of their own. Control
    strings inside texts and roles are escaped; :func:`read_conversations` reads them back. Very long texts are whole
    segments. Other columns are not looked at; an empty table has no rows.
    """
    clean = rows.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    # Written once, as a second run of the sort could cut other ranges.
    turns = stored(_followed(clean, template), "turns")
    firsts = _first_states(turns.select("range", "place", "conv_id", "states"), template)
    # A state for each range: a small table whatever the rows.
    known = turns.join(F.broadcast(firsts), "range")
    # The last entry is for a range that begins after an error.
    state = F.when(F.size("states") == 1, F.col("states")[0]).otherwise(F.element_at("states", F.when(F.col("first") < 0, -1).otherwise(F.col("first") + 1)))
    learnt = F.col("role").isin(*template.learnt)
    parts = []
    for part in template.turn:
        text = F.lit(part) if isinstance(part, str) else escaped_role(F.col("role")) if part == (ROLE,) else escaped(F.col("text"))
        parts.append(F.struct(text.alias("text"), (learnt if part == (TEXT,) else F.lit(False)).alias("loss")))
    return known.select("conv_id", "turn", "place", "role", F.array(*parts).cast(SEGMENTS).alias("segments"), state.alias("state"), (state >= 0).alias("valid"))


READ = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean, complete boolean"
)


class _Reader:
    """Reads the training text of one conversation back, whole turns at a time."""

    def __init__(self, template: Template):
        begin, after = template.turn[0], template.turn.index((TEXT,)) + 1
        end = "".join(template.turn[after:])
        self.turn = re.compile(re.escape(begin) + r"(.*?)\n(.*?)" + re.escape(end), re.DOTALL)
        self.template = template

    def start(self, conv: int | None) -> None:
        self.conv, self.n, self.loss, self.chars, self.valid, self.state = conv, 0, 0, 0, True, 0
        self.turns, self.learnt = hashlib.sha256(), hashlib.sha256()

    def add(self, text: str, masked: list[str], state: int) -> None:
        at = 0
        for match in iter(lambda: self.turn.match(text, at), None):
            self.turns.update(f"{unescaped_role(match[1])}\n{unescaped(match[2])}\n".encode())
            self.n, at = self.n + 1, match.end()
        if at != len(text):
            raise ValueError(f"conversation {self.conv} can't be read back at {text[at : at + 40]!r}")
        for part in masked:
            own = unescaped(part)
            self.loss += len(own)
            self.learnt.update(own.encode())
        self.chars, self.state = self.chars + len(text), state

    def row(self) -> tuple:
        done = self.state in self.template.final
        return self.conv, self.n, self.turns.hexdigest(), self.loss, self.learnt.hexdigest(), self.chars, self.state >= 0, done


def read_conversations(formatted: DataFrame, template: Template = CHAT) -> DataFrame:
    """Digests of each conversation, read back from the segments that :func:`format_conversations` made.

    The training text is cut into turns at the control strings and unescaped. A conversation's turns stream through one
    task in their order, batch by batch, as SHA-256 can't be computed in parts; memory doesn't grow with the conversation.
    """
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.bool_()]
    names = [x.split()[0] for x in READ.split(", ")]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, begun = _Reader(template), False
        for batch in batches:
            done, convs = [], batch.column("conv_id").to_pylist()
            for conv, segments, state in zip(convs, batch.column("segments").to_pylist(), batch.column("state").to_pylist()):
                if not begun or conv != reader.conv:
                    if begun:
                        done.append(reader.row())
                    reader.start(conv)
                    begun = True
                reader.add("".join(s["text"] for s in segments), [s["text"] for s in segments if s["loss"]], state)
            yield _batch(done, kinds, names)
        if begun:
            yield _batch([reader.row()], kinds, names)

    # The place only rises within a conversation; conversations lie in one task each.
    rows = formatted.select("conv_id", "place", "segments", "state").repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return in_batches(rows).mapInArrow(read, READ)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
