"""Exact top-k inner products with a vector-approximation file.

Vectors are whole numbers, floor(scale * x).  The approximation file holds an 8-bit cell for each
component and one cell width for each vector.  A scan of the cells bounds every score from below
and above, for a block of queries at a time as one matrix product; a vector stays in the race if
its upper bound reaches the k-th largest lower bound.  Exact vectors are then read for those few
alone and the k best scores are certain.

Equal vectors are one entry with the smallest of their ids, so a vector that a third of all rows
share is scored once, as a candidate and as a query.  Blocks of vectors meet blocks of queries,
each pair in a task of its own.  Vectors and blocks are shuffled, never broadcast: the driver holds
none of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapweave.llm.common import let, ship
from snapweave.session import store

SCALE = 256
K = 5
BLOCK = 8192
"""Vectors in a block of the approximation file, on average."""

QUERY_BLOCK = 2048
"""Queries that a block is scanned for at a time, on average."""

_SALTS = 16
_KEY = ["h1", "h2"]


def whole_vectors(vectors: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``(id, h1, h2, v)``: rows that take part, each id and vector once, with a 128-bit hash of it."""

    def valid(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf))

    doubles = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), doubles.alias("x"))
    rows = rows.filter(F.col("x").isNotNull() & F.forall("x", lambda x: F.coalesce(valid(x), F.lit(False))))
    rows = rows.filter("id is not null").select("id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"))
    rows = rows.select("id", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), F.col("v")).alias("h2"), "v")
    return rows.groupBy("id", *_KEY).agg(F.first("v").alias("v"))


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """``(h1, h2, ids, v)``: every vector once, with its ``ids`` smallest ids.

    A vector's rows meet in several salted groups first, each of which passes on few.
    """
    salted = Window.partitionBy(*_KEY, "salt").orderBy("id")
    some = (
        rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(_SALTS)))
        .withColumn("rank", F.row_number().over(salted))
        .filter(F.col("rank") <= ids)
        .drop("salt", "rank")
    )
    few = some.withColumn("rank", F.row_number().over(Window.partitionBy(*_KEY).orderBy("id"))).filter(
        F.col("rank") <= ids
    )
    return few.groupBy(*_KEY).agg(F.sort_array(F.collect_list("id")).alias("ids"), F.first("v").alias("v"))


def approximate(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(cells, shifts)`` of whole vectors (rows): component v lies in [c << s, (c << s) + (1 << s) - 1]."""
    largest = np.maximum(v.max(axis=1, initial=0), -1 - v.min(axis=1, initial=0))
    shifts = np.array([max(0, int(m).bit_length() - 7) for m in largest], np.int8)
    return (v >> shifts[:, None].astype(np.int64)).astype(np.int8), shifts


def bounds(cells: np.ndarray, shifts: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products, vectors by queries, with room for rounding."""
    width = np.exp2(shifts.astype(np.float64))[:, None]
    q = queries.astype(np.float64)
    middle = width * (cells.astype(np.float64) @ q.T) + (width - 1) / 2 * q.sum(axis=1)
    spread = (width - 1) / 2 * np.abs(q).sum(axis=1)
    slack = 1 + 1e-9 * (np.abs(middle) + spread)
    return middle - spread - slack, middle + spread + slack


def _blocks(rows: DataFrame, count: int, size: int, name: str) -> tuple[DataFrame, int]:
    """``rows`` with a block number by hash, and how many blocks there are."""
    blocks = max(1, math.ceil(count / size))
    return rows.withColumn(name, F.pmod("h1", F.lit(blocks))), blocks


def _pack_vectors(rows: pd.DataFrame) -> pd.DataFrame:
    cells, shifts = approximate(np.stack(rows["v"].to_numpy()).astype(np.int64))
    first = rows.iloc[0]
    return pd.DataFrame(
        {
            "dim": [first["dim"]],
            "block": [first["block"]],
            "h1s": [rows["h1"].to_numpy()],
            "h2s": [rows["h2"].to_numpy()],
            "cells": [cells.tobytes()],
            "shifts": [shifts.tobytes()],
        }
    )


def _pack_queries(rows: pd.DataFrame) -> pd.DataFrame:
    first = rows.iloc[0]
    return pd.DataFrame(
        {
            "dim": [first["dim"]],
            "qblock": [first["qblock"]],
            "q1s": [rows["h1"].to_numpy()],
            "q2s": [rows["h2"].to_numpy()],
            "q": [np.stack(rows["v"].to_numpy()).astype(np.int64).tobytes()],
        }
    )


def _scan(k: int):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for pair in batch.itertuples():
                shifts = np.frombuffer(pair.shifts, np.int8)
                cells = np.frombuffer(pair.cells, np.int8).reshape(len(shifts), pair.dim)
                queries = np.frombuffer(pair.q, np.int64).reshape(len(pair.q1s), pair.dim)
                h1s, h2s = np.asarray(pair.h1s), np.asarray(pair.h2s)
                for at in range(0, len(queries), 256):
                    low, high = bounds(cells, shifts, queries[at : at + 256])
                    if len(low) > k:
                        least = np.partition(low, len(low) - k, axis=0)[len(low) - k]
                    else:
                        least = np.full(low.shape[1], -np.inf)
                    row, column = np.nonzero(high >= least)
                    yield pd.DataFrame(
                        {
                            "q1": np.asarray(pair.q1s)[at + column],
                            "q2": np.asarray(pair.q2s)[at + column],
                            "h1": h1s[row],
                            "h2": h2s[row],
                            "low": low[row, column],
                            "high": high[row, column],
                        }
                    )

    return scan


def search(
    vectors: DataFrame,
    queries: Column,
    k: int = K,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best inner products of each query row.

    ``queries`` says which rows of ``vectors`` are queries, by ``key`` alone.  A query's own id is
    no candidate; ties go to the smaller id; with fewer candidates, all are returned.  Vectors that
    are null or hold a null or non-finite component, and rows without id, take no part; a vector
    meets those with as many components as it has.  Rows that repeat an id and vector count once.
    Scores are exact 64-bit sums; a pair whose sum does not fit is left out.  An empty table gives
    no rows.  Other columns are not read.
    """
    ship(vectors.sparkSession)
    rows = store(whole_vectors(vectors, key, vector, scale), "vectors")
    entries = store(distinct_vectors(rows, k + 1).withColumn("dim", F.size("v")), "entries")
    asking = store(rows.select("id", *_KEY).withColumn(key, F.col("id")).filter(queries).select("id", *_KEY), "asking")
    asked = store(entries.join(asking.select(*_KEY).distinct(), _KEY, "left_semi").select(*_KEY, "dim", "v"), "asked")

    left, blocks = _blocks(entries.select(*_KEY, "dim", "v"), entries.count(), BLOCK, "block")
    right, query_blocks = _blocks(asked, asked.count(), QUERY_BLOCK, "qblock")
    file = left.groupBy("dim", "block").applyInPandas(
        _pack_vectors, "dim int, block long, h1s array<long>, h2s array<long>, cells binary, shifts binary"
    )
    ask = right.groupBy("dim", "qblock").applyInPandas(
        _pack_queries, "dim int, qblock long, q1s array<long>, q2s array<long>, q binary"
    )
    every_query_block = F.sequence(F.lit(0).cast("bigint"), F.lit(query_blocks - 1).cast("bigint"))
    every_block = F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))
    # as many tasks as pairs, a task for each: adaptive execution goes by bytes, the work is arithmetic.
    # Both sides repeat their blocks; a broadcast, chosen by the size of their files, would hold all of that.
    tasks, pair = min(10_000, max(2, blocks * query_blocks)), ["dim", "block", "qblock"]
    cells = store(file, "approximations").withColumn("qblock", F.explode(every_query_block)).repartition(tasks, *pair)
    asks = store(ask, "queries").withColumn("block", F.explode(every_block)).repartition(tasks, *pair)
    raced = store(
        cells.join(asks.hint("merge"), pair).mapInPandas(
            _scan(k + 1), "q1 long, q2 long, h1 long, h2 long, low double, high double"
        ),
        "bounds",
    )

    by_query = Window.partitionBy("q1", "q2").orderBy(F.desc("low"))
    least = (
        raced.select("q1", "q2", "low")
        .withColumn("place", F.row_number().over(by_query))
        .filter(F.col("place") <= k + 1)
        .groupBy("q1", "q2")
        .agg(F.when(F.count(F.lit(1)) > k, F.min("low")).otherwise(F.lit(-math.inf)).alias("least"))
    )
    left_in = raced.join(least, ["q1", "q2"]).filter("high >= least").select("q1", "q2", *_KEY)
    # vectors are far larger in memory than in files, so their tables are not broadcast either
    exact = left_in.join(entries.select(*_KEY, "ids", "v").hint("merge"), _KEY).join(
        asked.select(F.col("h1").alias("q1"), F.col("h2").alias("q2"), F.col("v").alias("q")).hint("merge"), ["q1", "q2"]
    )
    products = F.zip_with("q", "v", lambda a, b: F.try_multiply(a, b))
    score = F.aggregate(products, F.lit(0).cast("bigint"), lambda a, b: F.try_add(a, b))
    scored = exact.select("q1", "q2", score.alias("score"), F.explode("ids").alias("vec")).filter("score is not null")
    best = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec")
    top = store(
        scored.withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k + 1)
        .groupBy("q1", "q2")
        .agg(F.sort_array(F.collect_list(F.struct("place", "vec", "score"))).alias("top")),
        "best",
    )
    others = let(F.struct("top", "id"), lambda r: F.slice(F.filter(r.top, lambda t: t.vec != r.id), 1, k))
    return (
        asking.join(top.select(F.col("q1").alias("h1"), F.col("q2").alias("h2"), "top"), _KEY)
        .select("id", F.posexplode(others).alias("n", "t"))
        .select(
            F.col("id").alias("query_id"),
            (F.col("n") + 1).cast("int").alias("rank"),
            F.col("t.vec").alias("vec_id"),
            F.col("t.score").alias("score"),
        )
    )
