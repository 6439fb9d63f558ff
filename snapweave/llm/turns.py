"""Conversations as runs of turns in order, whatever their length.

A conversation of ordinary length is brought together in one task and streamed from a sort.  One
with more than ``HOT_TURNS`` turns is range-partitioned by its order over many tasks; each piece
is numbered and summed up by itself, and the sums of the pieces are carried on, so that every turn
knows its place without the conversation ever meeting in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapweave.operators.skew import Split, split_hot
from snapweave.session import store

HOT_TURNS = 4096
PIECE = 50_000
_MAX_PIECES = 4_000  # the driver keeps a sample of 100 narrow keys for each


def narrow(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``(conv, turn, role, text)``; null roles and texts are empty."""
    none = F.lit("")
    return df.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), none).alias("role"),
        F.coalesce(F.col(text), none).alias("text"),
    )


def order() -> list[Column]:
    """Turns in order, null first; those of one number by role and text."""
    text = F.col("text")
    return [F.col("turn"), F.col("role"), F.substring(text, 1, 64), F.xxhash64(text)]


def part(turns: DataFrame, hot: int = HOT_TURNS) -> Split:
    """Turns of ordinary conversations, and of those above ``hot`` turns, null-safe."""
    return split_hot(turns, ["conv"], hot, counted=turns.select("conv"))


def together(turns: DataFrame) -> DataFrame:
    """Ordinary conversations next to each other in their tasks, each in order."""
    return turns.repartition("conv").sortWithinPartitions("conv", *order())


def placed(split: Split, weight: Column) -> DataFrame:
    """Hot conversations with ``pos``, a turn's rank from 0, and ``before``, the weights ahead of it; stored."""
    pieces = max(2, min(_MAX_PIECES, math.ceil(split.hot_rows / PIECE)))
    # turns alike in everything are told apart by a number, which any of them may have
    keys = [F.col("__k"), *order(), F.col("salt")]
    laid = store(
        split.hot.withColumns({"salt": F.monotonically_increasing_id(), "weight": weight})
        .repartitionByRange(pieces, *keys)
        .withColumn("piece", F.spark_partition_id()),
        "pieces",
    )
    none = F.lit(0).cast("bigint")
    earlier = Window.partitionBy("__k").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    sums = laid.groupBy("__k", "piece").agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("sum"))
    sums = sums.select(
        "__k",
        "piece",
        F.coalesce(F.sum("rows").over(earlier), none).alias("rows_ahead"),
        F.coalesce(F.sum("sum").over(earlier), none).alias("sum_ahead"),
    )
    inside = Window.partitionBy("__k", "piece").orderBy(*keys[1:])
    ahead = F.coalesce(F.sum("weight").over(inside.rowsBetween(Window.unboundedPreceding, -1)), none)
    numbered = laid.withColumns({"rank": F.row_number().over(inside) - 1, "ahead": ahead})
    return store(
        # a few rows for each piece
        numbered.join(F.broadcast(sums), ["__k", "piece"])
        .withColumns({"pos": F.col("rows_ahead") + F.col("rank"), "before": F.col("sum_ahead") + F.col("ahead")})
        .drop("rows_ahead", "sum_ahead", "rank", "ahead", "salt", "piece"),
        "placed",
    )


def runs(batches: Iterator[pa.RecordBatch], key: int = 1) -> Iterator[tuple[tuple, list[tuple]]]:
    """``(key values, rows)`` for each run of rows with the same first ``key`` columns."""
    current: tuple | None = None
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:key] != current:
                if current is not None:
                    yield current, rows
                current, rows = row[:key], []
            rows.append(row)
    if current is not None:
        yield current, rows


class Sink:
    """Rows of a task as record batches of a bounded size."""

    def __init__(self, schema: pa.Schema, chars: int = 1 << 23, rows: int = 5000):
        self._schema, self._chars, self._most = schema, chars, rows
        self._rows: list[tuple[Any, ...]] = []
        self._held = 0

    def add(self, row: tuple, chars: int = 0) -> None:
        self._rows.append(row)
        self._held += chars

    def full(self) -> bool:
        return self._held >= self._chars or len(self._rows) >= self._most

    def batch(self) -> pa.RecordBatch:
        columns = zip(*self._rows, strict=True) if self._rows else [()] * len(self._schema)
        arrays = [pa.array(list(c), f.type) for c, f in zip(columns, self._schema, strict=True)]
        self._rows, self._held = [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self._schema)
