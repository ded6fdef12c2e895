"""Operator 2, chat formatting with a grammar round trip.

A turn is ``### Role:`` (``User``, ``Assistant``, ``System``, or ``=`` and any
other role), a line feed, the text, and a line ``</turn>``.  Grammar::

    chat = turn*
    turn = "### " role ":\\n" text "\\n</turn>\\n"

where ``\\\\``, ``\\#``, ``\\<``, ``\\:`` and ``\\n`` stand for a backslash, ``#``,
``<``, ``:`` and a line feed, a text has no other ``###`` or ``</turn>``, and a role
no other ``#``, ``<``, ``:`` or line feed.  Rendering tries the plain text first,
reparses it with the deterministic parser, and escapes more until the recovered
turn is identical: plain, then marks escaped, then every backslash too.  The
last level always round-trips.

Rows render one by one, so a conversation that holds a third of all rows is
rendered by many tasks; only the digest of a conversation is sequential, and it
streams through its sorted turns without holding them.

Null text or role: empty.  Turns sort by turn (null first), role, rendered text; a
repeated row is one more turn.  Rows with a null conversation form one
conversation.  No rows give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import map_blocks

OPEN, CLOSE, MARK = "### ", "\n</turn>\n", "###"
END = "</turn>"
_NAMES = {"user": "User", "assistant": "Assistant", "system": "System"}
_ROLES = {v: k for k, v in _NAMES.items()}
_UNESCAPE = re.compile(r"\\([\\#<:n])")
_RUN = re.compile(r"#{3,}")
_ESCAPED = re.compile(r"\\.", re.S)
LEVELS = 3

RENDERED = "conv_id long, turn long, role string, text string, segment string, level int, loss_start int, loss_end int"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, escaped_turns long"
)


def escape(text: str, level: int) -> str:
    if level >= 2:
        text = text.replace("\\", "\\\\")
    if level >= 1:
        text = _RUN.sub(lambda m: "\\#" * len(m[0]), text).replace(END, "\\" + END)
    return text


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def render_role(role: str) -> str:
    """Known roles by their names; others after ``=``, escaped in full."""
    if role in _NAMES:
        return _NAMES[role]
    return "=" + re.sub(r"[\\#<:\n]", lambda m: "\\n" if m[0] == "\n" else "\\" + m[0], role)


def parse_role(raw: str) -> str:
    if raw in _ROLES:
        return _ROLES[raw]
    if raw[:1] != "=":
        raise ValueError("an unknown role")
    return unescape(raw[1:])


class Parser:
    """Deterministic, incremental: feed text, get whole turns."""

    def __init__(self) -> None:
        self.rest = ""

    def feed(self, text: str) -> list[tuple[str, str]]:
        """(role, text) of the turns completed by this text."""
        self.rest += text
        turns = []
        at = 0
        while (end := self.rest.find(CLOSE, at)) >= 0:
            turns.append(self._turn(self.rest[at : end + len(CLOSE)]))
            at = end + len(CLOSE)
        self.rest = self.rest[at:]
        return turns

    @staticmethod
    def _turn(raw: str) -> tuple[str, str]:
        if not raw.startswith(OPEN):
            raise ValueError("a turn must open with its mark")
        at = len(OPEN)
        while raw[at] != ":":
            if raw[at] in "\n<#":
                raise ValueError("a mark inside a role")
            at += 2 if raw[at] == "\\" else 1
        if raw[at + 1] != "\n":
            raise ValueError("a role must end its line")
        body = raw[at + 2 : len(raw) - len(CLOSE)]
        plain = _ESCAPED.sub("\0", body)
        if MARK in plain or END in plain:
            raise ValueError("a mark inside a text")
        return parse_role(raw[len(OPEN) : at]), unescape(body)

    def close(self) -> None:
        if self.rest:
            raise ValueError("text after the last turn")


def parse(text: str) -> list[tuple[str, str]]:
    parser = Parser()
    turns = parser.feed(text)
    parser.close()
    return turns


def render(role: str, text: str) -> tuple[str, int, int, int]:
    """(segment, level, start and end of the text in it): the least escaping
    whose reparse gives back this one turn."""
    head = f"{OPEN}{render_role(role)}:\n"
    for level in range(LEVELS):
        body = escape(text, level)
        segment = head + body + CLOSE
        try:
            if parse(segment) == [(role, text)]:
                return segment, level, len(head), len(head) + len(body)
        except (ValueError, IndexError):
            pass
    raise AssertionError("the last level round-trips")


def format_turns(rows: DataFrame) -> DataFrame:
    """Every turn rendered, with the span of its text for the loss mask (the
    assistant's turns; empty elsewhere).  Segments of a conversation in order,
    end to end, are its formatted text."""

    def make():
        def run(cols: dict[str, list]) -> dict[str, list]:
            roles, texts = [r or "" for r in cols["role"]], [t or "" for t in cols["text"]]
            done = [render(r, t) for r, t in zip(roles, texts)]
            loss = [(d[2], d[3]) if r == "assistant" else (d[2], d[2]) for r, d in zip(roles, done)]
            return {
                "conv_id": cols["conv_id"],
                "turn": cols["turn"],
                "role": roles,
                "text": texts,
                "segment": [d[0] for d in done],
                "level": [d[1] for d in done],
                "loss_start": [a for a, _ in loss],
                "loss_end": [b for _, b in loss],
            }

        return run

    cols = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    return map_blocks(cols, make, RENDERED)


class _Digest:
    """One conversation, read back from its segments as they come."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.parser = conv_id, Parser()
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.escaped = 0

    def add(self, segment: str, level: int, start: int, end: int) -> None:
        for role, text in self.parser.feed(segment):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        masked = unescape(segment[start:end])
        self.loss.update(masked.encode())
        self.loss_chars += len(masked)
        self.chars += len(segment)
        self.escaped += level > 0

    def row(self) -> tuple:
        self.parser.close()
        return (
            self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars,
            self.loss.hexdigest(), self.chars, self.escaped,
        )


def read_back(formatted: DataFrame) -> DataFrame:
    """Reparse each conversation's formatted text and digest turns and loss.

    Segments are dealt by conversation and sorted inside the task; the digest
    streams, so memory does not grow with a conversation.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    names = to_arrow_schema(formatted.sparkSession.createDataFrame([], DIGESTS).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []

        def flush() -> pa.RecordBatch:
            columns = zip(*rows) if rows else [[]] * len(names)
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=f.type) for c, f in zip(columns, names)], schema=names
            )
            rows.clear()
            return out

        for batch in batches:
            for conv_id, segment, level, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        rows.append(now.row())
                    now = _Digest(conv_id)
                now.add(segment, level, start, end)
            if rows:
                yield flush()
        if now is not None:
            rows.append(now.row())
        yield flush()

    thin = formatted.drop("text")
    dealt = thin.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "segment")
    return dealt.select("conv_id", "segment", "level", "loss_start", "loss_end").mapInArrow(run, DIGESTS)
