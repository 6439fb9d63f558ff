"""Conversation structure repair by the auction algorithm for shortest paths.

The turns of a conversation and the four places in the grammar ``(s?(ua)+)?`` of their roles span
a lattice: keeping, deleting or giving a turn another role leads to the next row, inserting a turn
stays in its row.  An auction finds the cheapest way through: the path from the start is extended
along the arc that its last node finds cheapest at present prices, or contracted when that node's
price has to rise.  Prices are integers and never exceed the true cost of what is left, and at a
node from which the path reached the end they are that cost.  The answer is traced along tight
arcs, the smallest letter first, after an auction from the arc's head has made its price true.

Rows are taken in stretches of ``STRETCH``; the prices at the entry of one are the price of leaving
the stretch before it.  A conversation of any length is cut into blocks: each block's costs from
entry to exit are found by itself, the blocks are put together by their few numbers, and each is
then traced on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from snapweave.llm.common import ship
from snapweave.llm.turns import HOT_TURNS, Sink, narrow, part, placed, runs, together
from snapweave.session import store

DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
STRETCH = 16
BLOCK = 4096

_NONE = float("inf")
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
FINAL = (0, _NONE, _NONE, 0)
"""What ending in each state costs: only nothing at all, or an assistant's turn, may come last."""

#: The state that a role leads to; a user's turn may follow all but a user's.
_STEPS = {
    "s": {START: AFTER_SYSTEM},
    "u": {START: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_ASSISTANT: AFTER_USER},
    "a": {AFTER_USER: AFTER_ASSISTANT},
    "o": {},
}
_FORCED = {START: AFTER_USER, AFTER_SYSTEM: AFTER_USER, AFTER_USER: AFTER_ASSISTANT, AFTER_ASSISTANT: AFTER_USER}
_NAMES = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}

_INITIALS, _FINE, _CUT, _GOES = "suao", 0, 1, 2
_WHITE = " \t\n\r\x0b\x0c"


def code(initial: str, fault: int) -> str:
    """A turn as the lattice sees it: what its role is, and whether it is fine, truncated or must go."""
    return "abcdefghijkl"[3 * _INITIALS.find(initial if initial and initial in "sua" else "o") + fault]


class Lattice:
    """A stretch of rows, what leaving it in each state costs, and the prices found so far."""

    def __init__(self, codes: str, leaving: tuple[float, ...], last: bool):
        rows = len(codes)
        self.end = 4 * (rows + 1)
        self.prices: list[float] = [0] * (self.end + 1)
        self.limit = 8 * rows + 16 + max(c for c in leaving if c < _NONE)
        self.arcs: list[list[tuple[str, float, int]]] = []
        for row in range(rows + 1):
            for state in range(4):
                at, arcs = 4 * row, []
                if row < rows:
                    kind, fault = divmod(ord(codes[row]) - 97, 3)
                    more = TRUNCATED if fault == _CUT else 0
                    arcs.append(("D", DELETE, at + 4 + state))
                if row < rows or last:
                    arcs.append(("I", INSERT, at + _FORCED[state]))
                if row < rows and fault != _GOES:
                    step = _STEPS[_INITIALS[kind]].get(state)
                    if step is not None:
                        arcs.append(("K", more, at + 4 + step))
                    arcs.append(("R", REROLE + more, at + 4 + _FORCED[state]))
                if row == rows and leaving[state] < _NONE:
                    arcs.insert(0, ("", leaving[state], self.end))
                self.arcs.append(arcs)

    def auction(self, origin: int) -> float:
        """The true cost from a node to the end; infinite if there is no way."""
        prices, arcs, path = self.prices, self.arcs, [origin]
        while path[-1] != self.end:
            node = path[-1]
            best, to = _NONE, -1
            for _, cost, head in arcs[node]:
                if cost + prices[head] < best:
                    best, to = cost + prices[head], head
            if best > prices[node]:
                prices[node] = best if best <= self.limit else _NONE
                if len(path) > 1:
                    path.pop()
                elif best > self.limit:
                    break
            elif to < 0:
                break
            else:
                path.append(to)
        return prices[origin]

    def trace(self, entry: int) -> tuple[str, int]:
        """``(edits, state)``: the least of the cheapest ways from an entry, and where it leaves."""
        self.auction(entry)
        node, edits, prices = entry, [], self.prices
        while True:
            for letter, cost, head in self.arcs[node]:
                if prices[node] == cost + prices[head] and prices[node] == cost + self.auction(head):
                    break
            else:
                raise ValueError("no way out of this state")
            if head == self.end:
                return "".join(edits), node % 4
            edits.append(letter)
            node = head


@lru_cache(maxsize=50_000)
def _entries(codes: str, leaving: tuple[float, ...], last: bool) -> tuple[float, ...]:
    lattice = Lattice(codes, leaving, last)
    return tuple(lattice.auction(state) for state in range(4))


@lru_cache(maxsize=50_000)
def _traced(codes: str, leaving: tuple[float, ...], last: bool, entry: int) -> tuple[str, int]:
    return Lattice(codes, leaving, last).trace(entry)


def _even(leaving: tuple[float, ...]) -> tuple[float, tuple[float, ...]]:
    """Costs less their smallest, so that stretches alike meet in the memory of those solved."""
    least = min(leaving)
    return least, tuple(c - least for c in leaving)


def entry_costs(codes: str, leaving: tuple[float, ...] = FINAL, last: bool = True) -> list[tuple[float, ...]]:
    """The costs of entering each stretch of ``codes`` in each state, and at last those of leaving."""
    costs = [leaving]
    for at in reversed(range(0, max(1, len(codes)), STRETCH)):
        least, rest = _even(costs[-1])
        final = last and at + STRETCH >= len(codes)
        costs.append(tuple(c + least for c in _entries(codes[at : at + STRETCH], rest, final)))
    return costs[::-1]


def edits(
    codes: str, leaving: tuple[float, ...] = FINAL, last: bool = True, entry: int = START
) -> tuple[float, str, int]:
    """``(cost, letters, state)`` of the cheapest edits, the ASCII-least of them."""
    costs = entry_costs(codes, leaving, last)
    state, letters = entry, []
    for n, at in enumerate(range(0, max(1, len(codes)), STRETCH)):
        final = last and at + STRETCH >= len(codes)
        found, state = _traced(codes[at : at + STRETCH], _even(costs[n + 1])[1], final, state)
        letters.append(found)
    return costs[0][entry], "".join(letters), state


class Repaired(NamedTuple):
    edit: str
    turn: object
    role: str
    text: str


def apply(rows: list[tuple], letters: str, state: int = START) -> list[Repaired]:
    """The turns that remain or are new; an inserted one has no number."""
    out, at = [], 0
    for letter in letters:
        if letter == "D":
            at += 1
            continue
        if letter == "I":
            state = _FORCED[state]
            out.append(Repaired("I", None, _NAMES[state], ""))
            continue
        turn, role, text = rows[at]
        state = _STEPS[role[0]][state] if letter == "K" else _FORCED[state]
        out.append(Repaired(letter, turn, role if letter == "K" else _NAMES[state], text))
        at += 1
    return out


def _sound(text: str) -> int:
    """Whether a text is fine, truncated, or blank and has to go."""
    last = text.rstrip(_WHITE)[-1:]
    return _GOES if not last else _FINE if last in ".!?" else _CUT


_LEGAL = {"su", "ua", "au"}
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def _schema(conv: T.DataType, turn: T.DataType) -> T.StructType:
    repaired = T.StructType(
        [T.StructField(n, t) for n, t in (("edit", T.StringType()), ("turn", turn), ("role", T.StringType()), ("text", T.StringType()))]
    )
    fields = [("conv", conv), ("part", T.LongType()), ("whole", T.BooleanType())]
    fields += [(n, T.LongType()) for n in _COUNTS] + [("audit", T.StringType())]
    fields += [("low", turn), ("high", turn), ("numbers", T.LongType())]
    fields += [("first_role", T.StringType()), ("last_role", T.StringType()), ("turns", T.ArrayType(repaired))]
    return T.StructType([T.StructField(*f) for f in fields])


def _part(key: object, number: int, whole: bool, rows: list[tuple], seen: list[bool], letters: str, cost: float, state: int) -> tuple:
    """A row of ``_schema`` from ``(turn, role, text)`` rows, of which some were seen before."""
    faults = [_sound(text) for *_, text in rows]
    blank = faults.count(_GOES)
    duplicate = sum(s and f != _GOES for s, f in zip(seen, faults, strict=True))
    truncated = sum(f == _CUT and not s for s, f in zip(seen, faults, strict=True))
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    turns = [t for t, *_ in rows if t is not None]
    left = [r._asdict() for r in apply(rows, letters, state)]
    ends = (turns[0], turns[-1]) if turns else (None, None)
    return (
        key, number, whole, blank, duplicate, truncated, illegal, int(cost), letters,
        *ends, len(set(turns)), initials[0], initials[-1], left,
    )


def repair(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    hot_turns: int = HOT_TURNS,
    block: int = BLOCK,
) -> DataFrame:
    """Every conversation's faults, its cheapest edits and the turns that they leave.

    A row for each conversation, or for each ``part`` of one above ``hot_turns`` turns, which is
    not ``whole``; counts and costs of parts add up, their audits and turns follow each other.
    Columns: conv, part, whole, blank, duplicate, truncated (turns by their first fault),
    illegal (neighbours within the part whose role initials are not su, ua or au), cost, audit
    (the edits' initials), low, high and numbers (smallest, largest and different turn numbers),
    first_role, last_role (initials), turns (edit, turn, role, text).

    Turns come by number, null ones first, those of one number by role and text.  Null roles and
    texts are empty; a null conversation is one of its own.  A role that is none of system, user
    and assistant by its first letter can be changed or deleted only.  Other columns are not read.
    Conversations without rows, and empty tables, give no rows.  Texts are shuffled once.
    """
    ship(conversations.sparkSession)
    turns = narrow(conversations, conv, turn, role, text)
    schema = _schema(turns.schema["conv"].dataType, turns.schema["turn"].dataType)
    arrow = to_arrow_schema(schema)
    split = part(turns, hot_turns)

    def whole_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sink(arrow)
        for (key,), found in runs(batches):
            known: set[tuple[str, str]] = set()
            seen, codes, rows = [], [], [r[1:] for r in found]
            for _, name, said in rows:
                seen.append((name, said) in known)
                known.add((name, said))
                codes.append(code(name[:1], _GOES if seen[-1] else _sound(said)))
            cost, letters, _ = edits("".join(codes))
            out.add(_part(key, 0, True, rows, seen, letters, cost, START), sum(len(r[2]) for r in rows))
            if out.full():
                yield out.batch()
        yield out.batch()

    found = together(split.cold).select("conv", "turn", "role", "text").mapInArrow(whole_ones, schema)
    return found if split.hot is None else found.union(_in_blocks(placed(split, F.lit(1)), schema, block))


def _in_blocks(turns: DataFrame, schema: T.StructType, block: int) -> DataFrame:
    """The same for conversations with their turns' places ``pos``, block by block."""
    arrow = to_arrow_schema(schema)
    turns = turns.withColumns({"part": F.floor(F.col("pos") / block), "said": F.sha2("text", 256)})
    firsts = turns.groupBy("__k", "role", "said").agg(F.min("pos").alias("first"))
    # a text that is everywhere is one row of ``firsts``; its turns may be split over tasks
    marked = turns.join(firsts, ["__k", "role", "said"]).withColumn("seen", F.col("pos") > F.col("first"))
    marked = store(marked.select("__k", "part", "pos", "conv", "turn", "role", "text", "seen"), "marked")

    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault = F.when(F.col("seen") | (last == ""), _GOES).when(last.isin(".", "!", "?"), _FINE).otherwise(_CUT)
    kind = F.expr("CASE WHEN initial <> '' AND locate(initial, 'sua') > 0 THEN locate(initial, 'sua') - 1 ELSE 3 END")
    letter = F.expr("substring('abcdefghijkl', 3 * kind + fault + 1, 1)")
    coded = marked.withColumn("initial", F.substring("role", 1, 1)).withColumns({"kind": kind, "fault": fault})
    blocks = coded.groupBy("__k", "part").agg(F.sort_array(F.collect_list(F.struct("pos", letter.alias("c")))).alias("cs"))
    blocks = store(blocks.select("__k", "part", F.array_join("cs.c", "").alias("codes")), "blocks")
    ends = blocks.groupBy("__k").agg(F.max("part").alias("end"))
    blocks = store(blocks.join(F.broadcast(ends), "__k").withColumn("last", F.col("part") == F.col("end")).drop("end"), "blocks")
    unit = [tuple(0 if s == t else _NONE for s in range(4)) for t in range(4)]

    def crossed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What a block costs from each entry to each exit."""
        for rows in batches:
            rows["costs"] = [
                [c for u in ([FINAL] if end else unit) for c in entry_costs(codes, u, end)[0]]
                for codes, end in zip(rows["codes"], rows["last"], strict=True)
            ]
            yield rows[["__k", "part", "costs"]]

    def backward(rows: pd.DataFrame) -> pd.DataFrame:
        """What leaving each block costs: the sums carried from the last block to the first."""
        rows = rows.sort_values("part", ascending=False)
        after, left = list(FINAL), []
        for costs in rows["costs"]:
            left.append(after)
            if len(costs) == 4:
                after = list(costs)
            else:
                after = [min(costs[4 * t + s] + after[t] for t in range(4)) for s in range(4)]
        rows["leaving"] = left
        return rows[["__k", "part", "leaving"]]

    def exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Where each block is left, by where it is entered; -1 where there is no way."""
        for rows in batches:
            rows["exits"] = [
                [edits(c, tuple(w), end, s)[2] if entry_costs(c, tuple(w), end)[0][s] < _NONE else -1 for s in range(4)]
                for c, w, end in zip(rows["codes"], rows["leaving"], rows["last"], strict=True)
            ]
            yield rows[["__k", "part", "last", "leaving", "exits"]]

    def forward(rows: pd.DataFrame) -> pd.DataFrame:
        """Where each block is entered."""
        rows = rows.sort_values("part")
        state, entered = START, []
        for to in rows["exits"]:
            entered.append(state)
            state = to[state]
        rows["entry"] = entered
        return rows[["__k", "part", "last", "leaving", "entry"]]

    costs = blocks.mapInPandas(crossed, "__k bigint, part bigint, costs array<double>")
    leaving = costs.groupBy("__k").applyInPandas(backward, "__k bigint, part bigint, leaving array<double>")
    told = blocks.join(leaving, ["__k", "part"]).mapInPandas(
        exits, "__k bigint, part bigint, last boolean, leaving array<double>, exits array<int>"
    )
    # a block of thousands of turns is a few numbers here
    told = store(
        told.groupBy("__k").applyInPandas(
            forward, "__k bigint, part bigint, last boolean, leaving array<double>, entry int"
        ),
        "entered",
    )

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sink(arrow)
        for (_, number), found in runs(batches, 2):
            *_, end, leave, entry = found[0]
            rows, seen = [r[4:7] for r in found], [r[7] for r in found]
            codes = "".join(code(n[:1], _GOES if s else _sound(t)) for (_, n, t), s in zip(rows, seen, strict=True))
            leave = tuple(leave)
            cost, letters, to = edits(codes, leave, end, entry)
            own = cost - (0 if end else leave[to])
            out.add(_part(found[0][3], number, False, rows, seen, letters, own, entry), sum(len(r[2]) for r in rows))
            if out.full():
                yield out.batch()
        yield out.batch()

    columns = ["__k", "part", "pos", "conv", "turn", "role", "text", "seen", "last", "leaving", "entry"]
    return (
        marked.join(told, ["__k", "part"])
        .select(*columns)
        .repartition("__k", "part")
        .sortWithinPartitions("__k", "part", "pos")
        .mapInArrow(parts, schema)
    )


def summaries(parts: DataFrame) -> DataFrame:
    """A row for each conversation of ``repair``: its counts, gaps, cost, audit and a digest.

    ``gaps`` is how many numbers between the smallest and the largest turn are missing, 0 where all
    are null.  ``repaired_sha256`` is that of the repaired turns' ``role:text``, joined by newlines.
    Whole conversations are read where they are; parts come together in order, as one stream.
    """
    ship(parts.sparkSession)
    said = F.transform("turns", lambda t: F.concat(F.lit("\n"), t.role, F.lit(":"), t.text))
    spelled = F.array_join(said, "")
    turn = parts.schema["low"].dataType
    narrowed = parts.withColumns(
        {
            "digest": F.when(F.col("whole"), F.sha2(F.substring(spelled, 2, 2**31 - 1), 256)),
            "spelled": F.when(~F.col("whole"), spelled),
        }
    ).drop("turns")
    columns = ["conv", "part", *_COUNTS, "audit", "low", "high", "numbers", "first_role", "last_role", "digest", "spelled"]
    fields = [("conv", parts.schema["conv"].dataType), ("gaps", T.LongType())]
    fields += [(n, T.LongType()) for n in _COUNTS] + [("audit", T.StringType()), ("repaired_sha256", T.StringType())]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Sink(to_arrow_schema(schema))
        state: dict = {}

        def close() -> None:
            if state:
                low, high = state["low"], state["high"]
                gaps = 0 if low is None else high - low + 1 - state["numbers"]
                digest = state["digest"] or state["sha"].hexdigest()
                out.add((state["conv"], gaps, *state["counts"], "".join(state["audit"]), digest))

        for batch in batches:
            for key, _, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                *counts, audit, low, high, numbers, first, final, digest, text = rest
                if not state or digest or state["digest"] or key != state["conv"]:
                    close()
                    state = {"conv": key, "counts": counts, "audit": [audit], "low": low, "high": high, "numbers": numbers}
                    state |= {"last": final, "digest": digest, "sha": hashlib.sha256(), "begun": False}
                else:
                    counts[_COUNTS.index("illegal")] += state["last"] + first not in _LEGAL
                    state["counts"] = [a + b for a, b in zip(state["counts"], counts, strict=True)]
                    state["audit"].append(audit)
                    if low is not None:
                        # turns are in order, so only the number on the border can be counted twice
                        state["numbers"] += numbers - (state["high"] == low)
                        state["low"] = low if state["low"] is None else state["low"]
                        state["high"] = high
                    state["last"] = final
                if not digest and text:
                    state["sha"].update((text if state["begun"] else text[1:]).encode("utf-8", "surrogatepass"))
                    state["begun"] = True
            if out.full():
                yield out.batch()
        close()
        yield out.batch()

    return narrowed.select(*columns).repartition("conv").sortWithinPartitions("conv", "part").mapInArrow(joined, schema)
