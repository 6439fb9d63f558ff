"""Chat formatting in budgeted windows.

Every turn is spelled in a template and its tokens are counted; prefix sums of these counts choose
runs of whole turns that fill a window.  A window begins with the conversation's system turn and a
limited number of the turns before its own, both repeated from earlier windows; only its own
assistant turns are under the loss mask, so each is learned from once.

Windows do not cross the borders of segments, which lie at fixed sums of tokens.  A segment and
the turns before it that may be repeated are all that formatting needs, so a conversation of any
length is formatted by many tasks, with the same windows as in one.

The template marks turns by ``### role: `` and ``</turn>``.  Inside roles and texts a backslash
breaks up whatever looks like a mark or like a tokenizer's control token, so no text can contain
one, and is itself doubled; ``read_back`` undoes it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from snapweave.llm.common import ship
from snapweave.llm.tokens import ID_BYTES, WORD_BPE, encoder
from snapweave.llm.turns import HOT_TURNS, Sink, narrow, part, placed, runs, together
from snapweave.session import store

BUDGET = 2048
"""Tokens of a window; only a single turn with its system turn may exceed it."""

HISTORY = 512
"""Tokens of repeated turns at most."""

SEGMENT = 32 * BUDGET
"""Tokens between the places that no window crosses."""

LEARNED = "assistant"
SYSTEM = "system"

_END = "</turn>\n"
_ESCAPED = re.compile(r"\\|#(?=##)|<(?=[|/])")
_BACK = re.compile(r"(\\)\\|(#)\\(?=#)|(<)\\(?=[|/])")


class Turn(NamedTuple):
    role: str
    text: str
    tokens: int


def escape(text: str) -> str:
    return _ESCAPED.sub(r"\g<0>\\", text)


def unescape(text: str) -> str:
    return _BACK.sub(lambda m: m[0][0], text)


def spell(role: str, text: str) -> tuple[str, str]:
    """A turn's head and its escaped text; ``_END`` follows."""
    return f"### {escape(role).replace(':', ':' + chr(92))}: ", escape(text)


def read_back(window: str, repeated: int = 0) -> list[tuple[str, str, int, int]]:
    """``(role, text, start, end)`` of a window's own turns, those after the ``repeated`` first.

    ``start`` and ``end`` are where the escaped text lies, in code points.
    """
    out, at = [], 0
    for n, piece in enumerate(window.split(_END)[:-1]):
        head, _, text = piece[4:].partition(": ")
        if n >= repeated:
            role = unescape(head.replace(":" + chr(92), ":"))
            out.append((role, unescape(text), at + len(head) + 6, at + len(piece)))
        at += len(piece) + len(_END)
    return out


def spans(
    tokens: list[int], begin: int, end: int, head: int, low: int, budget: int, history: int
) -> Iterator[tuple[int, int, int]]:
    """``(first repeated, first own, end)`` of the windows that cover turns ``begin`` to ``end``.

    ``head`` is what the system turn takes in every window that it does not begin; turns before
    ``low`` are never repeated as history.
    """
    sums = np.concatenate(([0], np.cumsum(tokens)))
    at = begin
    while at < end:
        taken = head if at >= low else 0
        room = max(0, min(history, budget - taken - tokens[at]))
        first = max(low, int(np.searchsorted(sums, sums[at] - room)))
        first = min(first, at)
        fits = int(np.searchsorted(sums, sums[first] + budget - taken, side="right")) - 1
        after = min(max(fits, at + 1), end)
        yield first, at, after
        at = after


def windows_of(
    turns: list[Turn], begin: int, end: int, system: Turn | None, inside: bool, budget: int, history: int
) -> Iterator[tuple[int, int, int, int, str, list[dict[str, int]]]]:
    """``(first own, own turns, repeated turns, tokens, text, loss)`` of each window.

    ``inside`` tells that the system turn is the first of ``turns``.
    """
    low = int(inside)
    head = system.tokens if system else 0
    tokens = [t.tokens for t in turns]
    for first, at, after in spans(tokens, begin, end, head, low, budget, history):
        shown = turns[first:after]
        repeated = at - first
        if system and at >= low:
            shown, repeated = [system, *shown], repeated + 1
        pieces, loss, length = [], [], 0
        for n, turn in enumerate(shown):
            name, body = spell(turn.role, turn.text)
            if n >= repeated and turn.role == LEARNED and body:
                loss.append({"start": length + len(name), "end": length + len(name) + len(body)})
            pieces += [name, body, _END]
            length += len(name) + len(body) + len(_END)
        yield at, after - at, repeated, sum(t.tokens for t in shown), "".join(pieces), loss


def _schema(conv: T.DataType) -> T.StructType:
    loss = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    fields = [("conv", conv), ("at", T.LongType()), ("n_turns", T.LongType()), ("n_repeated", T.LongType())]
    fields += [("n_tokens", T.LongType()), ("whole", T.BooleanType()), ("text", T.StringType()), ("loss", T.ArrayType(loss))]
    return T.StructType([T.StructField(*f) for f in fields])


def _counter(vocabulary: str):
    encode = encoder(vocabulary).encode

    def count(role: str, text: str) -> int:
        return len(encode("".join((*spell(role, text), _END)))) // ID_BYTES

    return count


def format_windows(
    conversations: DataFrame,
    budget: int = BUDGET,
    history: int = HISTORY,
    vocabulary: str = WORD_BPE,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    hot_turns: int = HOT_TURNS,
    segment: int = SEGMENT,
) -> DataFrame:
    """Windows ``(conv, at, n_turns, n_repeated, n_tokens, whole, text, loss)`` of every conversation.

    ``at`` counts the tokens of the turns before the window's own and orders the windows;
    ``n_turns`` are its own turns, ``n_repeated`` the ones shown before them again; ``loss`` has
    the code point spans (end exclusive) of its own assistant texts, escaped as they stand there,
    without their marks; empty texts have none.  ``whole`` tells that the window is the whole of an ordinary conversation.

    Turns come by number, null ones first, those of one number by role and text; repeated rows are
    turns of their own.  Null roles and texts are empty.  A null conversation is one of its own.
    The leading turn is retained in all windows if its role is ``system``; other system turns are
    turns like any.  A turn larger than the budget fills a window by itself.  Other columns are
    not read.  An empty table gives no rows.  ``segment`` is more than ``history``.  Texts are
    shuffled once.
    """
    spark = conversations.sparkSession
    ship(spark)
    turns = narrow(conversations, conv, turn, role, text)
    schema = _schema(turns.schema["conv"].dataType)
    arrow = to_arrow_schema(schema)
    split = part(turns, hot_turns)

    def whole_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, out = _counter(vocabulary), Sink(arrow)
        for (key,), rows in runs(batches):
            made = [Turn(r, t, count(r, t)) for _, r, t in rows]
            before = np.concatenate(([0], np.cumsum([t.tokens for t in made])))
            system = made[0] if made[0].role == SYSTEM else None
            borders = np.flatnonzero(np.diff(before[:-1] // segment)) + 1
            for begin, end in zip([0, *borders.tolist()], [*borders.tolist(), len(made)], strict=True):
                for at, own, *rest in windows_of(made, begin, end, system, bool(system), budget, history):
                    whole = at == 0 and own == len(made)
                    out.add((key, int(before[at]), own, *rest[:2], whole, *rest[2:]), len(rest[2]))
                    if out.full():
                        yield out.batch()
        yield out.batch()

    found = together(split.cold).select("conv", "role", "text").mapInArrow(whole_ones, schema)
    if split.hot is None:
        return found

    @F.pandas_udf("long")
    def counted(roles: pd.Series, texts: pd.Series) -> pd.Series:
        count = _counter(vocabulary)
        return pd.Series([count(r, t) for r, t in zip(roles, texts, strict=True)], dtype="int64")

    turns = placed(split, counted("role", "text"))
    turns = turns.withColumn("segment", F.floor(F.col("before") / segment))
    in_order = Window.partitionBy("__k").orderBy("segment")
    starts = turns.groupBy("__k", "segment").agg(F.min("before").alias("start"))
    starts = starts.withColumns({"next": F.lead("segment").over(in_order), "next_start": F.lead("start").over(in_order)})
    starts = store(starts, "segments")
    head = (F.col("pos") == 0) & (F.col("role") == SYSTEM)
    # only the segment just before another holds turns near enough to be repeated there
    shown = [F.struct(F.col("segment"), F.lit(True).alias("own")), F.struct(F.col("next").alias("segment"), F.lit(False).alias("own"))]
    near = ~head & F.coalesce(F.col("before") >= F.col("next_start") - history, F.lit(False))
    columns = ["__k", "segment", "conv", "pos", "own", "role", "text", "weight", "before"]
    dealt = turns.join(starts, ["__k", "segment"]).withColumn(
        "to", F.explode(F.when(near, F.array(*shown)).otherwise(F.array(shown[0])))
    )
    dealt = dealt.withColumns({"segment": F.col("to.segment"), "own": F.col("to.own")}).select(*columns)
    heads = turns.filter(head).drop("segment").join(starts.filter("start > 0").select("__k", "segment"), "__k")
    heads = heads.withColumns({"pos": F.lit(-1).cast("bigint"), "own": F.lit(False)}).select(*columns)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sink(arrow)
        for _, rows in runs(batches, 2):
            made = [Turn(*r[5:8]) for r in rows]
            inside = rows[0][3] == 0 and made[0].role == SYSTEM
            system = made[0] if inside else None
            if rows[0][3] == -1:
                system, made, rows = made[0], made[1:], rows[1:]
            begin = next(n for n, r in enumerate(rows) if r[4])
            for at, own, *rest in windows_of(made, begin, len(made), system, inside, budget, history):
                out.add((rows[at][2], rows[at][8], own, *rest[:2], False, *rest[2:]), len(rest[2]))
                if out.full():
                    yield out.batch()
        yield out.batch()

    spread = dealt.unionByName(heads).repartition("__k", "segment").sortWithinPartitions("__k", "segment", "pos")
    return found.union(spread.mapInArrow(segments, schema))


def digests(windows: DataFrame) -> DataFrame:
    """What the windows of each conversation say, read back from them, a row for each.

    Columns: conv, n_turns, turns_sha256 (of role, newline, text, newline for every turn),
    loss_chars and loss_sha256 (of all text under the loss mask, unescaped, end to end),
    formatted_chars.  A conversation in one window is read where it is; a digest of more is one
    stream, in the order of the windows, of which no more than a batch is held.
    """
    ship(windows.sparkSession)
    conv = windows.schema["conv"].dataType
    middle = T.StructType(
        [
            T.StructField("conv", conv),
            T.StructField("at", T.LongType()),
            *[T.StructField(n, T.LongType()) for n in ("n_turns", "loss_chars", "formatted_chars")],
            *[T.StructField(n, T.StringType()) for n in ("turns_sha256", "loss_sha256")],
            *[T.StructField(n, T.BinaryType()) for n in ("turns", "learned")],
        ]
    )
    last = T.StructType([f for f in middle.fields if f.name not in ("at", "turns", "learned")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sink(to_arrow_schema(middle))
        for batch in batches:
            for key, at, repeated, whole, text, loss in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                turns = read_back(text, repeated)
                said = "".join(f"{r}\n{t}\n" for r, t, _, _ in turns).encode("utf-8", "surrogatepass")
                heard = "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
                raw = heard.encode("utf-8", "surrogatepass")
                sums = (len(turns), len(heard), len(text))
                if whole:
                    out.add((key, at, *sums, hashlib.sha256(said).hexdigest(), hashlib.sha256(raw).hexdigest(), None, None))
                else:
                    out.add((key, at, *sums, None, None, said, raw), len(said) + len(raw))
                if out.full():
                    yield out.batch()
        yield out.batch()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sink(to_arrow_schema(last))
        current, sums, said, heard = None, [0, 0, 0], None, None
        for batch in batches:
            for key, _, *numbers, turns_sha, loss_sha, turns, learned in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if turns is None:
                    out.add((key, *numbers, turns_sha, loss_sha))
                    continue
                if said is None or key != current:
                    if said is not None:
                        out.add((current, *sums, said.hexdigest(), heard.hexdigest()))
                    current, sums, said, heard = key, [0, 0, 0], hashlib.sha256(), hashlib.sha256()
                sums = [a + b for a, b in zip(sums, numbers, strict=True)]
                said.update(turns)
                heard.update(learned)
            yield out.batch()
        if said is not None:
            out.add((current, *sums, said.hexdigest(), heard.hexdigest()))
        yield out.batch()

    parts = windows.select("conv", "at", "n_repeated", "whole", "text", "loss").mapInArrow(read, middle)
    return parts.repartition("conv").sortWithinPartitions("conv", "at").mapInArrow(joined, last)
