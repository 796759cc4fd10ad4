r"""Chat formatting: turns checked by a finite-state machine, written by a template.

A template is declarative: what stands before and after a turn of each role, which roles a
model learns, and which role may follow which. A turn becomes segments of text, each with a
loss flag; all segments in order are the formatted conversation.

Texts may hold what looks like the template's own control strings. Inside texts a backslash
stands before every backslash, and one after the first character of every control string, so
that none is left; taking away each backslash and keeping what follows it gives the text
back. Reading is therefore exact, and no text can open or close a turn.

Conversations are dealt to tasks by their id and sorted by turn there, and stream through in
batches: what a task holds is a batch and the part it is writing, also where one conversation
has a third of all rows. A formatted conversation is cut between turns into parts of some
PART_CHARS, so that no row grows with it. Turns and digests of one conversation are in
sequence by definition; nothing of it is gathered.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from userflow.llm.tables import stored

PART_CHARS = 1 << 20
START = ""  # the state before the first turn


@dataclass(frozen=True)
class Template:
    """``names``: what a role is called in its head; ``open`` + name + ``named`` stands before
    a text, ``close`` + ``end`` after it. Roles without a name are written as ``other`` and
    the role itself. ``learnt`` roles have their texts under the loss mask. ``follows``: the
    roles that may come in a state, which is the role before (START at first); a conversation
    may end in ``final`` states."""

    names: Mapping[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    open: str = "### "
    named: str = ": "
    other: str = "Role "
    close: str = "</turn>"
    end: str = "\n"
    learnt: frozenset[str] = frozenset({"assistant"})
    follows: Mapping[str, frozenset[str]] = field(
        default_factory=lambda: {
            START: frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )
    final: frozenset[str] = frozenset({"assistant"})

    def __post_init__(self) -> None:
        parts = [self.open, self.named, self.other, self.close, *self.names.values()]
        if not all(parts) or "\\" in "".join([*parts, self.end]):
            raise ValueError("the parts of a template are not empty and have no backslash")
        if min(map(len, [self.named, *self.controls()])) < 2:
            raise ValueError("control strings have two characters at least")
        ends = (self.close + self.end, self.named)
        if any(s.startswith(s[-n:]) for s in ends for n in range(1, len(s))):
            raise ValueError("what ends a role or a text must not begin with its own end")
        if len(set(self.names.values())) < len(self.names) or any(n.startswith(self.other) for n in self.names.values()):
            raise ValueError("each role needs a name of its own")

    def controls(self) -> list[str]:
        """What a text must not hold: heads and the closing string."""
        names = [*self.names.values(), self.other]
        return [*(self.open + name for name in names), self.close]


class Codec:
    """Writes and reads turns by a template."""

    def __init__(self, template: Template):
        self.template = template
        controls = sorted(map(re.escape, template.controls()), key=len, reverse=True)
        self.breaks = re.compile(f"(?s)(?=(?:{'|'.join(controls)}))(.)")
        self.named = re.compile(f"(?={re.escape(template.named)})(.)", re.S)
        self.roles = {name: role for role, name in template.names.items()}
        known = "|".join(map(re.escape, sorted(self.roles, key=len, reverse=True)))
        # A role without a name runs to the first separator that no backslash breaks.
        other = rf"{re.escape(template.other)}(?P<other>(?:\\.|[^\\])*?)"
        self.turn = re.compile(
            f"(?s){re.escape(template.open)}(?:(?P<name>{known})|{other}){re.escape(template.named)}"
            f"(?P<text>.*?){re.escape(template.close + template.end)}"
        )

    def escaped(self, text: str) -> str:
        return self.breaks.sub(r"\1\\", text.replace("\\", "\\\\"))

    def unescaped(self, text: str) -> str:
        return re.sub(r"(?s)\\(.)", r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """A turn as pieces of text, each with its loss flag."""
        t = self.template
        name = t.names.get(role)
        if name is None:
            name = t.other + self.named.sub(r"\1\\", self.escaped(role))
        return [(t.open + name + t.named, False), (self.escaped(text), role in t.learnt), (t.close + t.end, False)]

    def read(self, formatted: str) -> Iterator[tuple[str, str, int, int]]:
        """(role, text, where the text starts and ends) of each turn."""
        at = 0
        while at < len(formatted):
            found = self.turn.match(formatted, at)
            if found is None:
                raise ValueError(f"no turn at {at}")
            role = self.roles.get(found["name"]) if found["name"] is not None else self.unescaped(found["other"])
            yield role, self.unescaped(found["text"]), found.start("text"), found.end("text")
            at = found.end()


class Machine:
    """The roles' finite-state machine over one conversation."""

    def __init__(self, template: Template):
        self.template, self.state, self.turns, self.broken = template, START, 0, None

    def step(self, role: str) -> None:
        if self.broken is None and role not in self.template.follows.get(self.state, ()):
            self.broken = self.turns
        self.state = role
        self.turns += 1

    def first_violation(self) -> int | None:
        """The turn (from 0) that may not come there; the number of turns if the
        conversation must not end where it does; else None."""
        if self.broken is None and self.state not in self.template.final:
            return self.turns
        return self.broken


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    rows = (row for batch in batches for row in batch.to_pylist())
    return itertools.groupby(rows, key=lambda row: row["conv_id"])


_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("past", pa.int64())]))
_PARTS = pa.schema(
    [
        ("conv_id", pa.int64()), ("part", pa.int64()), ("turns", pa.int64()), ("formatted", pa.string()),
        ("loss", _LOSS), ("last", pa.bool_()), ("first_violation", pa.int64()),
    ]
)


class _Batches:
    """Rows as record batches of bounded size."""

    def __init__(self, schema: pa.Schema, weight: str | None = None):
        self.schema, self.weight, self.rows, self.held = schema, weight, [], 0

    def add(self, row: dict) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.held += len(row[self.weight]) if self.weight else 1
        if self.held >= PART_CHARS or len(self.rows) >= 4096:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, self.schema)
        self.rows, self.held = [], 0


def _written(template: Template, part_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, out = Codec(template), _Batches(_PARTS, "formatted")
        for conv_id, rows in _by_conversation(batches):
            machine, part = Machine(template), 0
            pieces, loss, size, turns = [], [], 0, 0
            for row in rows:
                if size >= part_chars:
                    yield from out.add(
                        {"conv_id": conv_id, "part": part, "turns": turns, "formatted": "".join(pieces), "loss": loss, "last": False, "first_violation": None}
                    )
                    pieces, loss, size, turns, part = [], [], 0, 0, part + 1
                machine.step(row["role"])
                turns += 1
                for piece, learnt in codec.segments(row["role"], row["text"]):
                    if learnt:
                        loss.append({"start": size, "past": size + len(piece)})
                    pieces.append(piece)
                    size += len(piece)
            yield from out.add(
                {
                    "conv_id": conv_id, "part": part, "turns": turns, "formatted": "".join(pieces), "loss": loss, "last": True,
                    "first_violation": machine.first_violation(),
                }
            )
        yield from out.rest()

    return run


def formatted(
    conversations: DataFrame, template: Template | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", part_chars: int = PART_CHARS,
) -> DataFrame:
    """Conversations as text: conv_id, part (from 0), turns (of the part), formatted, loss
    (spans of the formatted part under the loss mask, in code points), last (whether it is
    the last part) and, with the last part, first_violation: the first turn that may not come
    where it does, the number of turns if the conversation must not end there, else null.

    A part holds whole turns; a new one begins when it has ``part_chars`` code points. Turns
    are in the order of ``turn``, null first; those of one number by role, then by text, and
    repeated rows are each a turn. A null text or role is empty; a role that the template
    does not know is written with its own name and breaks the order. Rows without a conv_id
    make one conversation without an id. Other columns are not looked at; an empty table
    gives no rows. A conversation out of order is formatted all the same.
    """
    template = template or Template()
    rows = conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    schema = (
        "conv_id long, part long, turns long, formatted string, loss array<struct<start: long, past: long>>, last boolean, first_violation long"
    )
    return rows.mapInArrow(_written(template, part_chars), schema)


def segments(parts: DataFrame) -> DataFrame:
    """The pieces of ``formatted`` parts: conv_id, part, segment (from 0), text, loss. Their
    texts in order are the part; neighbours differ in the flag, and none is empty unless it
    is a learnt text."""
    # Cut at the ends of the spans: a learnt piece for each span, the rest between them.
    ends = F.concat(
        F.flatten(
            F.transform(
                "loss",
                lambda s, i: F.array(
                    F.struct(F.when(i == 0, F.lit(0)).otherwise(F.element_at("loss", F.greatest(i, F.lit(1)))["past"]).cast("long").alias("start"), s["start"].alias("past"), F.lit(False).alias("loss")),
                    F.struct(s["start"].alias("start"), s["past"].alias("past"), F.lit(True).alias("loss")),
                ),
            )
        ),
        F.array(
            F.struct(
                F.coalesce(F.try_element_at("loss", F.lit(-1))["past"], F.lit(0)).cast("long").alias("start"),
                F.char_length("formatted").cast("long").alias("past"),
                F.lit(False).alias("loss"),
            )
        ),
    )
    cut = parts.select("conv_id", "part", "formatted", F.posexplode(ends).alias("segment", "span"))
    piece = F.substring("formatted", (F.col("span.start") + 1).cast("int"), (F.col("span.past") - F.col("span.start")).cast("int"))
    return cut.select("conv_id", "part", "segment", piece.alias("text"), F.col("span.loss").alias("loss")).where("loss or text <> ''")


_TURNS = pa.schema(
    [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("loss", pa.bool_())]
)


def _in_order(parts: DataFrame) -> DataFrame:
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "part", "formatted", "loss", "last", "first_violation")


def _turns(codec: Codec, row: dict) -> Iterator[tuple[str, str, bool]]:
    """(role, text, loss) of a part's turns; the flag is what the mask says."""
    masked = {(s["start"], s["past"]) for s in row["loss"]}
    for role, text, start, past in codec.read(row["formatted"]):
        yield role, text, (start, past) in masked


def read(parts: DataFrame, template: Template | None = None) -> DataFrame:
    """The turns that ``formatted`` parts hold: conv_id, turn (from 0), role, text, loss."""
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, out = Codec(template), _Batches(_TURNS, "text")
        for conv_id, rows in _by_conversation(batches):
            turns = (turn for row in rows for turn in _turns(codec, row))
            for number, (role, text, loss) in enumerate(turns):
                yield from out.add({"conv_id": conv_id, "turn": number, "role": role, "text": text, "loss": loss})
        yield from out.rest()

    return _in_order(parts).mapInArrow(run, "conv_id long, turn long, role string, text string, loss boolean")


_DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("first_violation", pa.int64()),
    ]
)


def digests(parts: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation of ``formatted`` parts, read back from their text: conv_id, n_turns,
    turns_sha256 (of role, newline, text, newline of each turn), loss_chars and loss_sha256
    (of all text under the loss mask, unescaped), formatted_chars, first_violation."""
    template = template or Template()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, out = Codec(template), _Batches(_DIGESTS)
        for conv_id, rows in _by_conversation(batches):
            whole, learnt = hashlib.sha256(), hashlib.sha256()
            n = loss_chars = chars = 0
            violation = None
            for row in rows:
                chars += len(row["formatted"])
                violation = row["first_violation"]
                for start, past in ((s["start"], s["past"]) for s in row["loss"]):
                    text = codec.unescaped(row["formatted"][start:past])
                    loss_chars += len(text)
                    learnt.update(text.encode())
                for role, text, _ in _turns(codec, row):
                    n += 1
                    whole.update(f"{role}\n{text}\n".encode())
            yield from out.add(
                {
                    "conv_id": conv_id, "n_turns": n, "turns_sha256": whole.hexdigest(), "loss_chars": loss_chars,
                    "loss_sha256": learnt.hexdigest(), "formatted_chars": chars, "first_violation": violation,
                }
            )
        yield from out.rest()

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, first_violation long"
    )
    return _in_order(parts).mapInArrow(run, schema)


def round_trip(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """``digests`` of the conversations formatted, written and read back."""
    return digests(stored(formatted(conversations, template), "chat"), template)
