"""Keys that hold too many rows for one task.

Ordered operators (previous row, next row) need all rows of a key side by side, which puts a key
with a third of a table into one task.  ``split_hot`` finds such keys with one pre-aggregated
count of their rows; ``segment`` cuts their rows into range partitions of the order, so that each piece is
worked on by itself and only one summary row per piece has to be looked at together.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.session import materialize, store

HOT_ROWS = 2_000_000
"""Rows of one key that a single task still sorts comfortably."""

SMALL_ROWS = 200_000
"""Row count up to which a lookup table is broadcast."""

SMALL_KEYS = 1_000_000
"""The same for tables of a few short columns."""

_MAX_LISTED_KEYS = 100_000
_COUNTED_ROWS = 20_000  # rows of a hot key that are enough to tell it by
_MAX_SEGMENTS = 4_000  # range partitioning keeps a sample of 100 rows per piece on the driver


class Split(NamedTuple):
    cold: DataFrame
    hot: DataFrame | None
    hot_rows: int


def as_list(columns: str | Sequence[str]) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    """Null-safe equality of column pairs, as one join condition."""
    condition = F.lit(True)
    for i, (a, b) in enumerate(pairs):
        equal = left[a].eqNullSafe(right[b])
        condition = equal if i == 0 else condition & equal
    return condition


def broadcast_if_small(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that the table is small; else leave it to Spark."""
    return F.broadcast(df) if df.count() <= max_rows else df


def split_hot(
    df: DataFrame,
    key: Sequence[str],
    hot_rows: int | None = HOT_ROWS,
    counted: DataFrame | None = None,
) -> Split:
    """Part ``df`` into rows of ordinary keys and rows of keys above ``hot_rows`` rows.

    Hot rows carry ``__k``, a small number standing for their key.  For a high ``hot_rows`` the
    count is an estimate from a share of the rows, which keeps its shuffle small; it only decides
    how rows are laid out, and every row is in one part or the other.  ``counted`` may name a
    cheaper table with the same number of rows per key.  ``hot_rows=None`` skips the count, for
    callers that know their keys to be bounded.
    """
    if hot_rows is None:
        return Split(df, None, 0)
    spark = df.sparkSession
    share = min(1.0, _COUNTED_ROWS / max(1, hot_rows))
    seen = (df if counted is None else counted).select(*key)
    counts = (
        (seen.sample(share, seed=0) if share < 1 else seen)
        .groupBy(*key)
        .agg((F.count(F.lit(1)) / share).cast("long").alias("__n"))
        .filter(F.col("__n") > hot_rows)
    )
    listed = counts.limit(_MAX_LISTED_KEYS + 1).collect()
    if not listed:
        return Split(df, None, 0)
    if len(listed) <= _MAX_LISTED_KEYS:
        schema = T.StructType([*counts.schema.fields, T.StructField("__k", T.LongType())])
        numbered = spark.createDataFrame([(*row, i) for i, row in enumerate(listed)], schema)
        keys, total = F.broadcast(numbered), sum(row["__n"] for row in listed)
    else:
        keys = materialize(counts.withColumn("__k", F.monotonically_increasing_id()))
        total = keys.agg(F.sum("__n")).first()[0]
    keys = keys.select("__k", *[F.col(c).alias(f"__key_{i}") for i, c in enumerate(key)])
    condition = same(df, keys, [(c, f"__key_{i}") for i, c in enumerate(key)])
    hot = df.join(keys, condition).drop(*[f"__key_{i}" for i in range(len(key))])
    return Split(df.join(keys, condition, "left_anti"), hot, int(total))


def segment(hot: DataFrame, order: Sequence[str], rows: int, segment_rows: int) -> DataFrame:
    """Add ``__seg``: consecutive pieces of each hot key in the given order.

    Range partitioning spreads a key over as many tasks as it needs.  The result is written to
    reliable storage, so a lost executor cannot move a boundary between two uses.  Exact copies
    are merged before the shuffle: range partitioning could not separate them.
    """
    pieces = max(2, min(_MAX_SEGMENTS, math.ceil(rows / max(1, segment_rows))))
    return store(
        hot.distinct()
        .repartitionByRange(pieces, "__k", *order)
        .withColumn("__seg", F.spark_partition_id()),
        "segments",
    )
