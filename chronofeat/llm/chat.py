"""Chat formatting by a state machine over roles, and its exact inverse."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """How turns are written, which texts count for the loss, and which role may follow which.

    `turn` lists the segments of a turn. Inside texts and role names a backslash goes before each
    backslash and between the two characters of the control string's start, so marks are unique.
    """

    turn: tuple[str, ...] = ("<|{role}|>\n", "{text}", "<|end|>\n")
    loss_roles: tuple[str, ...] = ("assistant",)
    starts: tuple[str, ...] = ("system", "user")
    follows: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("system", ("user",)),
        ("user", ("assistant",)),
        ("assistant", ("user",)),
    )
    ends: tuple[str, ...] = ("assistant",)


CHAT = Template()
_ESCAPED = re.compile(r"\\([\\|])")
_HEAD = re.compile(r"<\|((?:[^\\|]|\\.)*)\|>\n", re.DOTALL)
_END = "<|end|>\n"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str) -> str:
    return role.replace("\\", "\\\\").replace("|", "\\|")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


class Turns:
    """The state machine: which roles may come next."""

    def __init__(self, template: Template):
        self.next, self.table = template.starts, dict(template.follows)

    def step(self, role: str) -> bool:
        allowed = role in self.next
        self.next = self.table.get(role, ())
        return allowed


_SEGMENT = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("turn", pa.int64()),
        ("segment", pa.int32()),
        ("text", pa.string()),
        ("loss", pa.bool_()),
        ("allowed", pa.bool_()),
    ]
)


def format_chats(chats: DataFrame, template: Template = CHAT) -> DataFrame:
    """Segments of all conversations: conv_id, turn (from 0), segment, text, loss, allowed.

    `chats` has conv_id, turn, role, text. Turns are ordered by turn, then role and text; nulls come
    first. Null roles and texts count as empty, null conversation ids are one conversation, repeated
    rows are turns of their own. Turns out of order are written like others and marked not allowed
    from the state machine's view. Each conversation's rows stream through one task, and only the
    state machine is held, so a conversation may be of any length. No rows give no segments.
    """
    rows = chats.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, current, number, turns = False, None, 0, None
        for batch in batches:
            out = []
            columns = (batch.column(k).to_pylist() for k in (0, 2, 3))
            for conv, role, text in zip(*columns, strict=True):
                if not started or conv != current:
                    started, current, number, turns = True, conv, 0, Turns(template)
                allowed = turns.step(role)
                loss = role in template.loss_roles
                for k, segment in enumerate(template.turn):
                    body = segment == "{text}"
                    written = escape(text) if body else segment.replace("{role}", escape_role(role))
                    out.append((conv, number, k, written, body and loss, allowed))
                number += 1
            yield _batch(out, _SEGMENT)

    return rows.select("conv_id", "turn", "role", "text").mapInArrow(
        run, "conv_id long, turn long, segment int, text string, loss boolean, allowed boolean"
    )


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class _Reader:
    """Reads one conversation back from its segments' texts and loss flags alone."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.digest, self.loss_digest = hashlib.sha256(), hashlib.sha256()
        self.pending, self.valid, self.last = "", True, None

    def add(self, text: str, loss: bool, allowed: bool) -> None:
        self.chars += len(text)
        self.valid = self.valid and allowed
        if loss:
            plain = unescape(text)
            self.loss_chars += len(plain)
            self.loss_digest.update(plain.encode())
        self.pending += text
        if not text.endswith(_END):
            return
        head = _HEAD.match(self.pending)
        end = self.pending.find(_END, head.end()) if head else -1
        while head and end >= 0:
            role, body = unescape(head[1]), unescape(self.pending[head.end() : end])
            self.digest.update(f"{role}\n{body}\n".encode())
            self.turns, self.last = self.turns + 1, role
            self.pending = self.pending[end + len(_END) :]
            head = _HEAD.match(self.pending)
            end = self.pending.find(_END, head.end()) if head else -1

    def row(self, conv: int | None, ends: tuple[str, ...]) -> tuple:
        if self.pending:
            raise ValueError(f"conversation {conv} does not end with a turn")
        return (
            conv,
            self.turns,
            self.digest.hexdigest(),
            self.loss_chars,
            self.loss_digest.hexdigest(),
            self.chars,
            self.valid,
            self.valid and self.last in ends,
        )


_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("valid", pa.bool_()),
        ("complete", pa.bool_()),
    ]
)


def in_order(segments: DataFrame) -> DataFrame:
    """Segments that have been shuffled since, in the order that `read_back` needs."""
    return segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")


def read_back(segments: DataFrame, template: Template = CHAT) -> DataFrame:
    """Digests of each conversation as read from the output of `format_chats`, in one pass.

    `valid` says that every turn was allowed, `complete` that moreover the last role may end a
    conversation. Segments are read in the order in which that function writes them, so they need no
    shuffle; rows in any other order are refused, and `in_order` restores it. No segments give no
    rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, reader, before = None, None, (0, 0)
        for batch in batches:
            out = []
            columns = (c.to_pylist() for c in batch.columns)
            for conv, turn, segment, text, loss, allowed in zip(*columns, strict=True):
                if reader is None or conv != current:
                    if reader is not None:
                        out.append(reader.row(current, template.ends))
                    current, reader, expected = conv, _Reader(), [(0, 0)]
                else:
                    expected = [(before[0], before[1] + 1), (before[0] + 1, 0)]
                if (turn, segment) not in expected:
                    raise ValueError(f"the segments of conversation {conv} are not in order")
                before = turn, segment
                reader.add(text, loss, allowed)
            yield _batch(out, _READ)
        if reader is not None:
            yield _batch([reader.row(current, template.ends)], _READ)

    names = ["conv_id", "turn", "segment", "text", "loss", "allowed"]
    return segments.select(*names).mapInArrow(
        run,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean, complete boolean",
    )
