"""Conversations as training text: a finite-state machine over roles and a declarative template.

The machine reads the turns of a conversation in order. It says whether each turn may follow the
one before it, and every turn becomes segments of text, each with a flag that says whether the
loss counts there. Turns out of order are formatted like others, so no text is lost; their conversation is
marked invalid. Control strings inside texts are escaped and can be read back.

A conversation is never gathered: rows are dealt by conversation and sorted by turn, and a task reads them
one after the other, holding one turn and the state of the machine and digests.

Defined results: a null text or role is empty; a null key is a conversation of its own; equal turns are
ordered by role and text; repeated rows are turns like others; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.llm.common import ROWS_AT_ONCE, to_arrow

#: Rows of the output handed over at once.
SEGMENTS_AT_ONCE = 4096
END = "end"


@dataclass(frozen=True)
class Template:
    """headers: what opens a turn of a role; other roles are named in `other`, escaped like texts.

    close: what ends a turn. loss: roles whose text counts. follows: roles that may come after a
    role ("" is the start, END the end of the conversation).
    """

    headers: dict[str, str] = field(default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    other: tuple[str, str] = ("### Role ", " ### Text: ")
    close: str = " </turn>\n"
    escape: str = "\\"
    loss: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user", END}),
        }
    )

    def controls(self) -> list[str]:
        return sorted({*self.headers.values(), *self.other, self.close}, key=lambda c: (-len(c), c))

    def escaper(self) -> re.Pattern:
        """Characters to be escaped: the escape itself, and those that open a control string.

        The rest of a text may also complete the start of a control string at its end.
        """
        openings = []
        for c in self.controls():
            rest = "(?:%s|(?:%s)\\Z)" % (re.escape(c[1:]), "|".join(re.escape(c[1:n]) for n in range(len(c), 0, -1)))
            openings.append(f"{re.escape(c[0])}(?={rest})")
        return re.compile("|".join([re.escape(self.escape), *openings]))

    def segments(self, role: str, text: str, escaper: re.Pattern) -> list[tuple[str, bool]]:
        """The text segments of one turn, each with its loss flag."""
        mark = lambda t: escaper.sub(lambda m: self.escape + m.group(), t)
        opening = self.headers.get(role)
        if opening is None:
            opening = self.other[0] + mark(role) + self.other[1]
        return [(opening, False), (mark(text), role in self.loss), (self.close, False)]

    def reader(self) -> re.Pattern:
        """Matches one formatted turn: a known opening or any other, text, and close."""
        inner = rf"(?:{re.escape(self.escape)}.|[^{re.escape(self.escape)}])*?"
        known = "|".join(f"(?P<r{i}>{re.escape(h)})" for i, h in enumerate(self.headers.values()))
        return re.compile(rf"(?:{known}|{re.escape(self.other[0])}(?P<other>{inner}){re.escape(self.other[1])})(?P<text>{inner}){re.escape(self.close)}", re.DOTALL)

    def plain(self, text: str) -> str:
        return re.sub(rf"{re.escape(self.escape)}(.)", r"\1", text, flags=re.DOTALL)

    def read(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Role and text of each turn, read back from formatted text."""
        roles, reader, at = list(self.headers), self.reader(), 0
        while at < len(formatted):
            m = reader.match(formatted, at)
            if not m:
                raise ValueError(f"no turn at character {at}")
            role = next((r for i, r in enumerate(roles) if m[f"r{i}"] is not None), None)
            yield (self.plain(m["other"]) if role is None else role), self.plain(m["text"])
            at = m.end()


class Machine:
    """State over the roles of one conversation."""

    def __init__(self, template: Template):
        self.template, self.state, self.valid = template, "", True

    def step(self, role: str) -> bool:
        """Whether the role may come next; reading it anyway."""
        allowed = role in self.template.follows.get(self.state, frozenset())
        self.valid &= allowed
        self.state = role
        return allowed

    def ends(self) -> bool:
        """Whether the conversation may end here, all its turns having been in order."""
        return self.valid and END in self.template.follows.get(self.state, frozenset())


def in_order(turns: DataFrame) -> DataFrame:
    """Turns dealt by conversation and sorted, ready to be read one after the other."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _turns(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            yield from zip(*(c.to_pylist() for c in part.columns), strict=True)


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def format_turns(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """(conv_id, position, segment, loss, in_order): the text segments of all conversations.

    The segments of a conversation, put together by position, are its formatted text.
    """
    template = template or Template()
    schema = "conv_id long, position long, segment string, loss boolean, in_order boolean"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        escaper, now, machine, position = template.escaper(), object(), None, 0
        for key, _, role, text in _turns(batches):
            if key != now:
                now, machine, position = key, Machine(template), 0
            allowed = machine.step(role)
            for segment, loss in template.segments(role, text, escaper):
                yield key, position, segment, loss, allowed
                position += 1

    return in_order(turns).mapInArrow(lambda batches: _batches(emit(batches), to_arrow(schema), SEGMENTS_AT_ONCE), schema)


def digest_conversations(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation, read back from its formatted turns.

    Turn by turn the segments are made, and from their text the turn is parsed again; digests run along.
    """
    template = template or Template()
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        escaper, now, state = template.escaper(), object(), None

        def row() -> tuple:
            machine, n, whole, loss, counted, chars = state
            return now, n, whole.hexdigest(), loss, counted.hexdigest(), chars, machine.ends()

        for key, _, role, text in _turns(batches):
            if key != now:
                if state:
                    yield row()
                now, state = key, [Machine(template), 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[0].step(role)
            segments = template.segments(role, text, escaper)
            formatted = "".join(s for s, _ in segments)
            for found, said in template.read(formatted):
                state[1] += 1
                state[2].update(f"{found}\n{said}\n".encode())
            for segment, counts in segments:
                if counts:
                    said = template.plain(segment)
                    state[3] += len(said)
                    state[4].update(said.encode())
            state[5] += len(formatted)
        if state:
            yield row()

    return in_order(turns).mapInArrow(lambda batches: _batches(emit(batches), to_arrow(schema), 1024), schema)


#: Fixed value: the conversation that the contract adds.
PROBE = (-7, r"\### Assistant: </turn> ok")


def with_probe(turns: DataFrame) -> DataFrame:
    """The turns and the added conversation: a user and an assistant row with the same text."""
    rows = [(PROBE[0], i, role, PROBE[1]) for i, role in enumerate(("user", "assistant"))]
    own = turns.select("conv_id", "turn", "role", "text")
    return own.unionByName(turns.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
