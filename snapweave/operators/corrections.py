"""Latest correction of a record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapweave.operators.skew import as_list


def latest_per(
    df: DataFrame,
    keys: str | Sequence[str],
    order_desc: str,
    tie: str | Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the one with the greatest ``order_desc`` (nulls come last).

    Equal ones are told apart by ``tie``, greatest first, then by every other column.
    Spark keeps one row per key on the map side already, so a hot key shuffles little.
    """
    keys = as_list(keys)
    first = [order_desc, *(as_list(tie) if tie is not None else [])]
    rest = [c for c in df.columns if c not in (*keys, *first)]
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in (*first, *rest)])
    return df.withColumn("__rank", F.row_number().over(newest)).filter("__rank = 1").drop("__rank")
