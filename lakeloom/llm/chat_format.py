"""Chat formatting by a finite-state machine over roles and a declarative template.

A ``Template`` names the marks around a turn, the titles of the roles, which roles are learnt
from, and the machine: which role may follow in which state. Every turn becomes segments, each
with its own loss flag: heading, text, closing mark. A mark spelt inside a text, and the escape
character itself, get an escape character in front, so that the output can be read back.

Turns are range-partitioned by conversation and turn, so a conversation of any length is dealt
over many tasks, and leave as pieces of bounded length. The machine starts in an unknown
state in a piece: a piece states, for every state it may be entered in, the state it ends in and
the first turn that has no step. Such functions are put together piece by piece.

Defined results: NULL text is empty; a NULL role and roles without a title are written so
that they read back; both have no step, so the order of their conversation is wrong; rows
without conversation form one; NULL turns come first; turns of one number are ordered by role,
then by a hash of the text and the text; repeated rows are turns of their own; very long texts
are a piece of their own; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.session import stage

#: A piece is closed when it has so many characters; a run of pieces this long is digested
#: in a second step, since it can't wait in memory for its end.
PIECE_CHARS = 1_000_000
HELD_CHARS = 8_000_000
EMIT_CHARS = 4_000_000

NULL_ROLE, OTHER_ROLE = "!", "?"


@dataclass(frozen=True)
class Template:
    """How turns are written and in which order they may come."""

    opens: str = "### "
    names: str = ": "
    closes: str = "</turn>"
    gap: str = "\n"
    escape: str = "\\"
    titles: dict[str, str] = field(
        default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"}
    )
    learnt: frozenset[str] = frozenset({"assistant"})
    #: state -> role -> next state; the first state is where a conversation begins.
    steps: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "told", "user": "asked"},
            "told": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    ends: frozenset[str] = frozenset({"answered"})

    def __post_init__(self):
        if len(self.escape) != 1 or self.escape in "".join(self.controls) + self.gap:
            raise ValueError("the escape is one character that no mark holds")
        if not all(self.controls) or len(set(self.titles.values())) < len(self.titles):
            raise ValueError("marks are not empty, titles differ")
        if any(t[:1] in ("", NULL_ROLE, OTHER_ROLE) or any(c in t for c in self.controls) for t in self.titles.values()):
            raise ValueError(f"a title is not empty, does not begin with {NULL_ROLE} or {OTHER_ROLE} and holds no mark")
        if any(a is not b and a.startswith(b) for a in self.controls for b in self.controls):
            raise ValueError("no mark begins with another")
        # The end of a text and the mark behind it must not spell a mark together.
        for behind in (self.closes, self.names):
            for mark in self.controls:
                for n in range(1, len(mark)):
                    both = mark[:n] + behind
                    if both.startswith(mark) or mark.startswith(both):
                        raise ValueError(f"{mark!r} may begin before {behind!r}")
        states = set(self.steps) | {s for of in self.steps.values() for s in of.values()}
        if not self.ends <= states:
            raise ValueError("a final state that no step reaches")

    @property
    def controls(self) -> tuple[str, str, str]:
        return self.opens, self.names, self.closes

    @property
    def states(self) -> list[str]:
        """All states, the first one first."""
        reached = [s for of in self.steps.values() for s in of.values()]
        return list(dict.fromkeys([*self.steps, *reached]))

    def moves(self) -> dict[str, list[int]]:
        """For every role the state that follows each state, -1 where there is no step."""
        states = self.states
        roles = {r for of in self.steps.values() for r in of}
        return {r: [states.index(to) if (to := self.steps.get(s, {}).get(r)) else -1 for s in states] for r in roles}


def escaped(text: Column, template: Template) -> Column:
    """The escape character in front of itself and of everything that spells a mark."""
    marks = "|".join("\\Q" + m + "\\E" for m in (template.escape, *template.controls))
    return F.regexp_replace(text, f"(?={marks})", re.sub(r"([\\$])", r"\\\1", template.escape))


def turn_segments(turns: DataFrame, template: Template) -> DataFrame:
    """``conv_id, turn, role, text`` with ``head``, ``body``, ``tail`` and whether ``body`` is ``learnt``."""
    role = F.col("role")
    title = F.when(role.isNull(), F.lit(NULL_ROLE))
    for name, written in template.titles.items():
        title = title.when(role == name, F.lit(written))
    title = title.otherwise(F.concat(F.lit(OTHER_ROLE), escaped(role, template)))
    text = F.coalesce("text", F.lit(""))
    return turns.select(
        "conv_id",
        "turn",
        "role",
        text.alias("text"),
        F.concat(F.lit(template.opens), title, F.lit(template.names)).alias("head"),
        escaped(text, template).alias("body"),
        F.lit(template.closes + template.gap).alias("tail"),
        F.coalesce(role.isin(*template.learnt), F.lit(False)).alias("learnt"),
    )


class Order:
    """The machine over a stretch of turns, entered in any state."""

    def __init__(self, n_states: int):
        self.states = list(range(n_states))
        self.wrong = [-1] * n_states
        self.turns = 0

    def turn(self, move: list[int]) -> None:
        for entry, state in enumerate(self.states):
            if state >= 0:
                self.states[entry] = move[state]
                if move[state] < 0:
                    self.wrong[entry] = self.turns
        self.turns += 1

    def append(self, states: list[int], wrong: list[int], turns: int) -> None:
        """What follows, as a function of the state it is entered in."""
        for entry, state in enumerate(self.states):
            if state >= 0:
                self.states[entry] = states[state]
                if states[state] < 0:
                    self.wrong[entry] = self.turns + wrong[state]
        self.turns += turns


PIECES = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("block", pa.int32()),
        ("piece", pa.int32()),
        ("n_turns", pa.int64()),
        ("text", pa.string()),
        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))),
        ("states", pa.list_(pa.int32())),
        ("wrong", pa.list_(pa.int64())),
    ]
)
_PIECES = (
    "conv_id bigint, block int, piece int, n_turns bigint, text string, "
    "loss array<struct<start: bigint, length: bigint>>, states array<int>, wrong array<bigint>"
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _write_pieces(template: Template, piece_chars: int):
    moves, n_states = template.moves(), len(template.states)
    nowhere = [-1] * n_states

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId()
        rows, held = [], 0
        now, piece = (), 0
        parts, loss, at, order = [], [], 0, Order(n_states)

        def close():
            text = "".join(parts)
            rows.append((now[0], block, piece, order.turns, text, loss, order.states, order.wrong))
            return len(text)

        for batch in batches:
            for conv, role, head, body, tail, learnt in zip(*(c.to_pylist() for c in batch.columns)):
                if (conv,) != now or at >= piece_chars:
                    if order.turns:
                        held += close()
                    piece = piece + 1 if (conv,) == now else 0
                    now, parts, loss, at, order = (conv,), [], [], 0, Order(n_states)
                if learnt:
                    loss.append({"start": at + len(head), "length": len(body)})
                parts += (head, body, tail)
                at += len(head) + len(body) + len(tail)
                order.turn(moves.get(role, nowhere))
                if held >= EMIT_CHARS:
                    yield _batch(rows, PIECES)
                    rows, held = [], 0
        if order.turns:
            close()
        yield _batch(rows, PIECES)

    return write


def format_conversations(turns: DataFrame, template: Template | None = None, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """Conversations as text, in order: by ``conv_id, block, piece``.

    ``loss`` has the spans (code points) of the piece to learn from. ``states`` and ``wrong``
    are the piece's function of the machine: by the state it is entered in, the state it
    ends in (-1: none) and the turn of the piece, from 0, that has no step (-1: none).
    The rows of a conversation are neighbours within a partition, and partitions are in order.
    """
    template = template or Template()
    place = [F.col("conv_id"), F.col("turn"), F.col("role"), F.xxhash64("text")]
    dealt = turn_segments(turns.select(F.col("conv_id").cast("bigint"), "turn", "role", "text"), template)
    in_order = dealt.repartitionByRange(*place).sortWithinPartitions(*place, "text")
    return in_order.select("conv_id", "role", "head", "body", "tail", "learnt").mapInArrow(
        _write_pieces(template, piece_chars), _PIECES
    )


def reader(template: Template):
    """A function that reads ``(role, text)`` of every turn back from a piece."""
    marks = "|".join(map(re.escape, template.controls))
    token = re.compile(f"{re.escape(template.escape)}(.)|({marks})", re.DOTALL)
    plain = re.compile(f"{re.escape(template.escape)}(.)", re.DOTALL)
    roles = {title: role for role, title in template.titles.items()}

    def until(text: str, at: int, mark: str) -> tuple[str, int]:
        """What stands before the next ``mark`` without escape, unescaped, and where it ends."""
        for m in token.finditer(text, at):
            if m.group(2) == mark:
                return plain.sub(r"\1", text[at : m.start()]), m.end()
        raise ValueError("a turn without its mark")

    def read(text: str) -> list[tuple[str | None, str]]:
        at, found = 0, []
        while at < len(text):
            if not text.startswith(template.opens, at):
                raise ValueError("a turn does not begin with its mark")
            title, at = until(text, at + len(template.opens), template.names)
            role = None if title == NULL_ROLE else title[1:] if title[0] == OTHER_ROLE else roles[title]
            body, at = until(text, at, template.closes)
            if not text.startswith(template.gap, at):
                raise ValueError("a turn does not end with its gap")
            at += len(template.gap)
            found.append((role, body))
        return found

    return read


def unescaped(text: str, template: Template) -> str:
    return re.sub(f"{re.escape(template.escape)}(.)", r"\1", text, flags=re.DOTALL)


class Digest:
    """What is read back from a conversation, piece after piece."""

    def __init__(self, n_states: int):
        self.order = Order(n_states)
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.loss_chars = self.chars = 0

    def add(self, turns: str, loss: str, n_turns: int, chars: int, states: list[int], wrong: list[int]) -> None:
        self.turns.update(turns.encode())
        self.loss.update(loss.encode())
        self.loss_chars += len(loss)
        self.chars += chars
        self.order.append(states, wrong, n_turns)

    def row(self, conv: int | None, template: Template) -> tuple:
        state, wrong = self.order.states[0], self.order.wrong[0]
        fine = state >= 0 and template.states[state] in template.ends
        return (
            conv, self.order.turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
            fine, wrong if wrong >= 0 else None,
        )


DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("order_ok", pa.bool_()),
        ("first_wrong", pa.int64()),
    ]
)
_DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
    "formatted_chars bigint, order_ok boolean, first_wrong bigint"
)
#: A finished conversation, or a piece of one that may go on in another partition.
READ = pa.schema(
    [*DIGESTS, ("block", pa.int32()), ("piece", pa.int32()), ("turns", pa.string()), ("learnt", pa.string()),
     ("states", pa.list_(pa.int32())), ("wrong", pa.list_(pa.int64()))]
)
_READ = _DIGESTS + ", block int, piece int, turns string, learnt string, states array<int>, wrong array<bigint>"


def _read_pieces(template: Template, held_chars: int):
    read, n_states = reader(template), len(template.states)

    def contents(text: str, loss: list[dict]) -> tuple[str, str]:
        turns = "".join(f"{role or ''}\n{body}\n" for role, body in read(text))
        return turns, "".join(unescaped(text[s["start"] : s["start"] + s["length"]], template) for s in loss)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now, run, size, is_open = [], None, [], 0, True

        def leave(still_open: bool):
            """The run ends here, or its pieces go on to the second step."""
            if still_open:
                rows.extend(
                    (conv, n, None, None, None, chars, None, None, block, piece, turns, loss, states, wrong)
                    for conv, block, piece, n, turns, loss, chars, states, wrong in run
                )
            elif run:
                whole = Digest(n_states)
                for _, _, _, n, turns, loss, chars, states, wrong in run:
                    whole.add(turns, loss, n, chars, states, wrong)
                rows.append((*whole.row(run[0][0], template), None, None, None, None, None, None))
            run.clear()

        for batch in batches:
            for conv, block, piece, n, text, loss, states, wrong in zip(*(c.to_pylist() for c in batch.columns)):
                if now is not None and (conv,) != now:
                    leave(is_open)
                    size, is_open = 0, False
                now = (conv,)
                run.append((conv, block, piece, n, *contents(text, loss), len(text), states, wrong))
                size += len(text)
                if size >= held_chars:
                    is_open = True
                    leave(True)
                    size = 0
                    yield _batch(rows, READ)
                    rows.clear()
            yield _batch(rows, READ)
            rows.clear()
        leave(True)
        yield _batch(rows, READ)

    return finish


def _join_pieces(template: Template):
    n_states = len(template.states)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now, whole = [], None, None
        for batch in batches:
            for conv, n, chars, turns, loss, states, wrong in zip(*(c.to_pylist() for c in batch.columns)):
                if (conv,) != now:
                    if now:
                        rows.append(whole.row(now[0], template))
                    now, whole = (conv,), Digest(n_states)
                whole.add(turns, loss, n, chars, states, wrong)
            yield _batch(rows, DIGESTS)
            rows = []
        if now:
            rows.append(whole.row(now[0], template))
        yield _batch(rows, DIGESTS)

    return join


def conversation_digests(pieces: DataFrame, template: Template | None = None, held_chars: int = HELD_CHARS) -> DataFrame:
    """One row per conversation, read back from what ``format_conversations`` returns.

    Pieces are read where they lie. Conversations inside one partition are finished there;
    those at its borders, and very long ones, are read there too, but only their contents move
    on, to be hashed in order as a stream: a digest has to see all of a conversation.
    """
    template = template or Template()
    read = stage(pieces.mapInArrow(_read_pieces(template, held_chars), _READ), "read-back")
    left = read.where("piece IS NOT NULL").select(
        "conv_id", "n_turns", "formatted_chars", "turns", "learnt", "states", "wrong", "block", "piece"
    )
    in_order = left.repartition("conv_id").sortWithinPartitions("conv_id", "block", "piece").drop("block", "piece")
    rest = in_order.mapInArrow(_join_pieces(template), _DIGESTS)
    return read.where("piece IS NULL").select(*DIGESTS.names).union(rest)

