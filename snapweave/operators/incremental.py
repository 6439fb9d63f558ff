"""Change intervals and latest facts kept up to date, without reading what was merged before.

The state of a table of intervals is the intervals themselves: an interval's row stands for all
snapshots between its start and its end.  Newer snapshots of an entity continue its last interval
or begin another; an entity that brings older ones is worked out again from its whole history,
and no other entity is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.operators.corrections import latest_per
from snapweave.operators.intervals import collapse_changes
from snapweave.operators.skew import HOT_ROWS, SMALL_KEYS, as_list, same
from snapweave.session import store, store_counted

_SEEN = "__last_seen"


def unfilled(column: str) -> str:
    """The state's column with what a backfilled column held before."""
    return f"unfilled_{column}"


def _of(df: DataFrame, keys: DataFrame, key: list[str], how: str) -> DataFrame:
    """Semi or anti join on null-safe keys."""
    named = keys.select(*[F.col(c).alias(f"__of_{i}") for i, c in enumerate(key)])
    return df.join(named, same(df, named, [(c, f"__of_{i}") for i, c in enumerate(key)]), how)


def merge_snapshots(
    state: DataFrame | None,
    new: DataFrame,
    key: str | Sequence[str],
    order: str,
    tracked: Sequence[str],
    *,
    history: Callable[[], DataFrame],
    backfill: Sequence[str] = (),
    start_as: str = "start_date",
    end_as: str = "end_date",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """The intervals that ``collapse_changes`` makes of all snapshots, from ``state`` and the ``new`` ones.

    ``state`` is what an earlier call returned, None at first: the intervals, with an
    ``unfilled_*`` column for each of ``backfill``, by which snapshots of one moment keep their
    order.  ``history`` gives all snapshots, the new ones included, with the columns of ``new``.  It
    is called only if an entity brings snapshots that are not later than all it had (a null order
    counts as such), and read for these entities only.  Entities without new snapshots keep their
    rows as they are.  ``new`` is stored, as is the list of its entities.
    """
    key = as_list(key)
    plain = [c for c in new.columns if c != order]
    columns = [*plain, *map(unfilled, backfill), start_as, end_as]
    tie = [unfilled(c) if c in backfill else c for c in plain if c not in key]

    def collapsed(rows: DataFrame) -> DataFrame:
        return collapse_changes(
            rows, key, order, tracked, end=_SEEN, tie=tie, backfill=backfill, start_as=start_as, end_as=end_as,
            hot_rows=hot_rows,
        ).select(*columns)

    def as_rows(snapshots: DataFrame) -> DataFrame:
        was = {unfilled(c): F.col(c) for c in backfill}
        return snapshots.select(*plain, order).withColumns({**was, _SEEN: F.col(order)})

    new = store(new, "new_snapshots")
    if state is None:
        return collapsed(as_rows(new))
    seen = state.groupBy(*key).agg(F.max(end_as).alias("__until"))
    came = new.groupBy(*[F.col(c).alias(f"__of_{i}") for i, c in enumerate(key)]).agg(
        F.min(order).alias("__first"), F.max(F.col(order).isNull()).alias("__unknown")
    )
    met = seen.join(came, same(seen, came, [(c, f"__of_{i}") for i, c in enumerate(key)]), "right")
    late = F.col("__unknown") | F.coalesce(F.col("__first") <= F.col("__until"), F.lit(False))
    touched, n = store_counted(
        met.select(*[F.col(f"__of_{i}").alias(c) for i, c in enumerate(key)], late.alias("late")), "touched"
    )

    def hint(keys: DataFrame) -> DataFrame:
        return F.broadcast(keys) if n <= SMALL_KEYS else keys

    again, on = hint(touched.filter("late")), hint(touched.filter("NOT late"))
    intervals = _of(state, on, key, "left_semi").withColumnsRenamed({start_as: order, end_as: _SEEN})
    both = store(intervals.unionByName(_of(as_rows(new), on, key, "left_semi")), "open_intervals")
    result = _of(state, hint(touched), key, "left_anti").select(*columns).unionByName(collapsed(both))
    if touched.filter("late").isEmpty():
        return result
    past = store(_of(as_rows(history()), again, key, "left_semi"), "late_histories")
    return result.unionByName(collapsed(past))


def merge_latest(state: DataFrame | None, new: DataFrame, keys: str | Sequence[str], order_desc: str) -> DataFrame:
    """What ``latest_per`` gives for all rows, from what it gave for the earlier ones and the ``new``."""
    rows = new if state is None else state.select(*new.columns).unionByName(new)
    return latest_per(rows, keys, order_desc)
