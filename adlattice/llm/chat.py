"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation, turn after turn::

    turn  := "### " role ": " body "\\n</turn>\\n"
    role  := characters other than % : \\ # < and line breaks; those are written as %XX of their UTF-8 bytes
    body  := text in which "### " and "</turn>" only stand behind at least one backslash

A text is first rendered as it is. The deterministic parser reads it back; while the result differs from the source, or
the parser refuses it, the next kind of conflicting content is escaped: every control string of that kind gets one more
backslash in front of it. The parser takes one backslash off each control string that has any. When every kind is
escaped the text always reads back identical, so the loop ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROLS = ("### ", "</turn>")
END = "\n</turn>\n"
_ANY = re.compile(r"(?<!\\)(\\*)(### |</turn>)")
_HEAD = re.compile(r"### ([^:\n]*): ")


class GrammarError(ValueError):
    """The text is not a sentence of the grammar."""


def escape(text: str, kinds: tuple[str, ...] = CONTROLS) -> str:
    return _ANY.sub(lambda m: m[1] + "\\" + m[2] if m[2] in kinds else m[0], text)


def unescape(text: str) -> str:
    return _ANY.sub(lambda m: m[1][1:] + m[2], text)


def render(role: str, body: str) -> str:
    return f"### {quote(role, safe=' ')}: {body}{END}"


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """Turns as (role, text, start of the body, end of the body); raises GrammarError."""
    out, at = [], 0
    while at < len(rendered):
        head = _HEAD.match(rendered, at)
        if not head:
            raise GrammarError(f"no turn header at {at}")
        for control in _ANY.finditer(rendered, head.end()):
            if not control[1]:
                break
        else:
            raise GrammarError(f"turn at {at} does not end")
        end = control.start() - 1
        if control[2] != "</turn>" or end < head.end() or rendered[end : end + len(END)] != END:
            raise GrammarError(f"control string inside the turn at {at}")
        out.append((unquote(head[1]), unescape(rendered[head.end() : end]), head.end(), end))
        at = end + len(END)
    return out


def format_turn(role: str | None, text: str | None) -> tuple[str, int, int, int]:
    """Rendered turn, span of its body, and how many kinds of content had to be escaped. Nulls count as empty."""
    role, text = role or "", text or ""
    for rounds in range(len(CONTROLS) + 1):
        rendered = render(role, escape(text, CONTROLS[:rounds]) if rounds else text)
        try:
            turns = parse(rendered)
        except GrammarError:
            continue
        if [t[:2] for t in turns] == [(role, text)]:
            return rendered, turns[0][2], turns[0][3], rounds
    raise AssertionError("a fully escaped turn reads back identical")


def format_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text") -> DataFrame:
    """One row per turn: (conv_id, turn, role, rendered, body_start, body_end, in_loss, rounds).

    The rendered turns of a conversation in turn order, joined by nothing, are its formatted text; body spans are in
    code points of the row's own ``rendered``. Assistant bodies are under the loss mask. A turn is formatted alone, so
    no conversation is gathered anywhere. Null roles and texts count as empty; a null ``conv_id`` or ``turn`` stays
    null; repeated rows stay repeated; other columns are left out; an empty table gives no rows.
    """
    narrow = df.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                       F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            made = [format_turn(r, t) for r, t in zip(roles, texts)]
            yield pa.RecordBatch.from_pydict({
                "conv_id": batch.column("conv_id"), "turn": batch.column("turn"), "role": batch.column("role"),
                "rendered": pa.array([m[0] for m in made], pa.string()),
                "body_start": pa.array([m[1] for m in made], pa.int64()),
                "body_end": pa.array([m[2] for m in made], pa.int64()),
                "in_loss": pa.array([r == "assistant" for r in roles], pa.bool_()),
                "rounds": pa.array([m[3] for m in made], pa.int32()),
            })

    return narrow.mapInArrow(run, "conv_id long, turn long, role string, rendered string, body_start long, "
                                  "body_end long, in_loss boolean, rounds int")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, read from the rendered turns alone.

    A digest over a conversation is one sequence by nature. Rows are dealt by conversation and sorted, and each task
    feeds them to running digests one by one, so a conversation of any length takes constant memory. Equal (conv_id,
    turn) rows follow by role and rendered text.
    """
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        state: list | None = None

        def close():
            conv, n, turns, loss_chars, loss, chars = state
            out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

        def flush():
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            made = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)
            out.clear()
            return made

        for batch in batches:
            for conv, rendered, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "rendered", "in_loss"))):
                if state is None or state[0] != conv:
                    if state is not None:
                        close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, start, end in parse(rendered):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                    if mask:
                        under = unescape(rendered[start:end])
                        state[3] += len(under)
                        state[4].update(under.encode())
                state[5] += len(rendered)
            yield flush()
        if state is not None:
            close()
            yield flush()

    return (
        formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "rendered")
        .select("conv_id", "rendered", "in_loss")
        .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                         "formatted_chars long")
    )
