"""Snapshots to change intervals, and repeated collapse of intervals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from snapweave.operators.skew import HOT_ROWS, as_list, same, segment, split_hot


def _order_by(df: DataFrame, key: list[str], order: str, tie: Sequence[str] | None) -> list[str]:
    """The order column and its tie-breakers: those given, then every other column, so that rows
    of one moment always come in the same order, however they are split."""
    first = [order, *(as_list(tie) if tie is not None else [])]
    return first + [c for c in df.columns if c not in (*key, *first)]


def _next_filled(column: str, window_parts: Sequence[str], order: Sequence[str]) -> Column:
    """First non-null value at or after the row, read backwards so that it is a running value."""
    backwards = (
        Window.partitionBy(*window_parts)
        .orderBy(*[F.col(c).desc_nulls_last() for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return F.last(column, ignorenulls=True).over(backwards)


def _differs(tracked: Sequence[str], ordered: WindowSpec) -> Column:
    """Whether any tracked column differs from the previous row.

    Column by column: a struct of them would be built before the shuffle and double its volume.
    """
    return reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.lag(c).over(ordered)) for c in tracked]
    )


def collapse_changes(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
    tracked: Sequence[str],
    *,
    end: str | None = None,
    tie: str | Sequence[str] | None = None,
    backfill: Sequence[str] = (),
    start_as: str = "start_date",
    end_as: str = "end_date",
    hot_rows: int | None = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Keep the rows at which the tracked state of an entity changes, with the time it lasted.

    ``order`` becomes ``start_as``.  ``end_as`` is the start of the next change, or for the last
    one the last ``order`` of the entity (with ``end``: the ``end`` of its last row).  States are
    compared null-safely.  ``backfill`` columns take their first non-null value from the row on,
    which does not count as a change.

    ``df`` is read twice, once for the number of rows per key (see ``split_hot`` for
    ``hot_rows`` and ``counted``), so it should be a stored table rather than a long computation.
    """
    key, tracked, backfill = as_list(key), as_list(tracked), as_list(backfill)
    by = _order_by(df, key, order, tie)
    names = [c for c in df.columns if c != end_as and c != order]
    cold, hot, rows = split_hot(df, key, hot_rows, counted)
    result = _collapse(cold, key, by, tracked, end, backfill)
    if hot is not None:
        pieces = segment(hot, by, rows, hot_rows)
        result = result.unionByName(
            _collapse_segments(pieces, by, tracked, end, backfill).select(*result.columns)
        )
    filled = {c: F.col(f"__filled_{i}").alias(c) for i, c in enumerate(backfill)}
    return result.select(
        *[filled.get(c, F.col(c)) for c in names],
        F.col(order).alias(start_as),
        F.col("__until").alias(end_as),
    )


def _collapse(df, key, by, tracked, end, backfill) -> DataFrame:
    order = by[0]
    forward = Window.partitionBy(*key).orderBy(*by)
    whole = forward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    changed = (F.row_number().over(forward) == 1) | _differs(tracked, forward)
    filled = {f"__filled_{i}": _next_filled(c, key, by) for i, c in enumerate(backfill)}
    return (
        df.withColumns({**filled, "__changed": changed, "__last": F.last(end or order).over(whole)})
        .filter("__changed")
        .withColumn("__until", F.coalesce(F.lead(order).over(forward), "__last"))
        .drop("__changed", "__last")
    )


def _collapse_segments(df, by, tracked, end, backfill) -> DataFrame:
    """The same on the pieces of hot keys: each piece alone, then one summary row per piece."""
    order, piece = by[0], ["__k", "__seg"]
    at = F.struct(*by)
    state = F.struct(*tracked)
    within = Window.partitionBy(*piece).orderBy(*by)
    across = Window.partitionBy("__k").orderBy("__seg")
    behind = (
        Window.partitionBy("__k")
        .orderBy(F.col("__seg").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )

    summary = df.groupBy(*piece).agg(
        F.max_by(state, at).alias("__state"),
        F.max_by(end or order, at).alias("__end"),
        *[
            F.min_by(c, F.when(F.col(c).isNotNull(), at)).alias(f"__fill_{i}")
            for i, c in enumerate(backfill)
        ],
    )
    whole = Window.partitionBy("__k")
    around = summary.select(
        *piece,
        F.lag(F.struct("__state")).over(across).alias("__before"),
        F.max_by("__end", "__seg").over(whole).alias("__last"),
        *[
            F.last(f"__fill_{i}", ignorenulls=True).over(behind).alias(f"__fill_{i}")
            for i in range(len(backfill))
        ],
    )

    opening = F.col("__before").isNull() | ~state.eqNullSafe(F.col("__before.__state"))
    changed = F.when(F.row_number().over(within) == 1, opening).otherwise(
        _differs(tracked, within)
    )
    filled = {
        f"__filled_{i}": F.coalesce(_next_filled(c, piece, by), F.col(f"__fill_{i}"))
        for i, c in enumerate(backfill)
    }
    changes = (
        df.join(around, piece)
        .withColumn("__changed", changed)
        .withColumns(filled)
        .filter("__changed")
    )
    next_start = (
        changes.groupBy(*piece)
        .agg(F.min_by(order, at).alias("__first"))
        .select(*piece, F.lead("__first").over(across).alias("__next"))
    )
    return (
        changes.withColumn("__lead", F.lead(order).over(within))
        .join(next_start, piece)
        .withColumn("__until", F.coalesce("__lead", "__next", "__last"))
    )


def recollapse(
    df: DataFrame,
    key: str | Sequence[str],
    start: str,
    end: str,
    tracked: Sequence[str],
    *,
    tie: str | Sequence[str] | None = None,
    hot_rows: int | None = HOT_ROWS,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Merge neighbouring intervals whose tracked state became equal."""
    merged = collapse_changes(
        df, key, start, tracked, end=end, tie=tie, start_as=start, end_as=end,
        hot_rows=hot_rows, counted=counted,
    )
    return merged.select(*df.columns)


def backfill_first(
    df: DataFrame,
    column: str,
    key: str | Sequence[str],
    order: str,
    *,
    tie: str | Sequence[str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Give ``column`` its first non-null value from each row on, in the order of the entity."""
    key = as_list(key)
    by = _order_by(df, key, order, tie)
    cold, hot, rows = split_hot(df, key, hot_rows)
    result = cold.withColumn(column, _next_filled(column, key, by))
    if hot is None:
        return result
    ids = list(dict.fromkeys(["__k", *by, column]))
    pieces = segment(hot.select(*ids), [c for c in ids if c != "__k"], rows, hot_rows)
    behind = (
        Window.partitionBy("__k")
        .orderBy(F.col("__seg").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    at = F.struct(*by)
    later = (
        pieces.groupBy("__k", "__seg")
        .agg(F.min_by(column, F.when(F.col(column).isNotNull(), at)).alias("__fill"))
        .select("__k", "__seg", F.last("__fill", ignorenulls=True).over(behind).alias("__fill"))
    )
    values = (
        pieces.join(later, ["__k", "__seg"])
        .withColumn(
            "__value", F.coalesce(_next_filled(column, ["__k", "__seg"], by), F.col("__fill"))
        )
        .select("__value", *[F.col(c).alias(f"__id_{i}") for i, c in enumerate(ids)])
    )
    joined = hot.join(values, same(hot, values, [(c, f"__id_{i}") for i, c in enumerate(ids)]))
    return result.unionByName(
        joined.withColumn(column, F.col("__value")).select(*df.columns)
    )
