"""Intervals to a yearly panel."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.operators.skew import as_list


def explode_years(df: DataFrame, start: str, end: str, year: str = "year") -> DataFrame:
    """One row per calendar year the interval touches, both ends included.

    A missing end drops the row; an interval written backwards covers the same years.
    """
    first, last = F.year(start), F.year(end)
    years = F.sequence(F.least(first, last), F.greatest(first, last))
    whole = first.isNotNull() & last.isNotNull()
    return df.filter(whole).withColumn(year, F.explode(years))


def panelize(
    intervals: DataFrame,
    facts: Sequence[DataFrame] = (),
    *,
    key: str | Sequence[str] = "tin",
    start: str = "start_date",
    end: str = "end_date",
    year: str = "year",
    one_per_year: bool = False,
    few_per_key: bool = False,
) -> DataFrame:
    """Yearly panel of the intervals with yearly facts attached by key and year.

    Several fact rows of one key and year repeat the panel row; ``one_per_year`` keeps the
    greatest one.  The fact tables are brought together first, so that the large panel is
    shuffled for a single join, which Spark may split where a key is skewed.  ``few_per_key`` says
    that no key has more facts than a row can hold, such as the latest of each period: then a
    key's facts meet its intervals as one row, and the years are made afterwards and never move.
    """
    on = [*as_list(key), year]
    tables = [f.withColumn(year, F.col(year).cast("int")) for f in facts if f is not None]
    if one_per_year:
        tables = [_one_per(f, on) for f in tables]
    if few_per_key and tables:
        return _gathered(intervals, tables, as_list(key), start, end, year)
    panel = explode_years(intervals, start, end, year)
    if not tables:
        return panel
    together = reduce(lambda a, b: a.join(b, on, "full"), [t.dropna(subset=on) for t in tables])
    return panel.join(together, on, "left")


def _gathered(
    intervals: DataFrame, tables: list[DataFrame], key: list[str], start: str, end: str, year: str
) -> DataFrame:
    """The panel by way of one row of facts per key."""
    joined, measures = intervals, []
    for n, table in enumerate(tables):
        rest = [c for c in table.columns if c not in (*key, year)]
        listed = F.collect_list(F.struct(F.col(year).alias("__year"), *rest)).alias(f"__facts{n}")
        joined = joined.join(table.dropna(subset=[*key, year]).groupBy(*key).agg(listed), key, "left")
        measures += [F.col(f"__fact{n}.{c}").alias(c) for c in rest]
    panel = explode_years(joined, start, end, year)
    for n in range(len(tables)):
        same_year = F.filter(f"__facts{n}", lambda f: f["__year"] == F.col(year))
        panel = panel.withColumn(f"__fact{n}", F.explode_outer(same_year))
    rest = [c for c in intervals.columns if c not in key]
    return panel.select(*key, year, *rest, *measures)


def _one_per(facts: DataFrame, on: list[str]) -> DataFrame:
    rest = [c for c in facts.columns if c not in on]
    return facts.groupBy(*on).agg(F.max(F.struct(*rest)).alias("__f")).select(*on, "__f.*")
