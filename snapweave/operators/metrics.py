"""Row counts taken while the data is written, without a second scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observe(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, and an observation whose ``get["rows"]`` is their number once they ran.

    A total sort or range partitioning afterwards samples its input first, which would count rows
    twice: observe the sorted rows instead.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def order(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in the order of the columns, for reading or for a sorted export."""
    return df.orderBy(*columns)
