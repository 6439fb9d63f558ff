"""Registry snapshots to change intervals, yearly facts to one row per entity and period."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave import schemas
from snapweave.functions.text import pad_id, upper_columns
from snapweave.operators.corrections import latest_per
from snapweave.operators.filters import exclude_patterns, possible_keys
from snapweave.operators.incremental import merge_snapshots
from snapweave.operators.intervals import collapse_changes
from snapweave.operators.skew import HOT_ROWS

MEASURES = {"revexp": ["revenue", "expenditure"], "empl": ["employees_count"]}


def registry_snapshots(
    df: DataFrame, *, excluded: Sequence[str] = tuple(schemas.EXCLUDED_REGIONS), keep_null_region: bool = False
) -> DataFrame:
    """Extracted registry rows as snapshots of entities, with their number and ``data_date``."""
    kept = exclude_patterns(df, "region_name", excluded, keep_null_region) if excluded else df
    named = upper_columns(kept, [*schemas.NAME_COLUMNS, *schemas.ADDRESS_COLUMNS])
    entities = named.withColumns(
        {
            "tin": F.coalesce(pad_id("ind_tin", 12), pad_id("org_tin", 10)),
            "reg_number": F.coalesce("ind_number", "org_number"),
        }
    )
    columns = [c for c in schemas.SME_AGGREGATED.names if c not in ("start_date", "end_date")]
    return entities.select(*columns, "data_date")


def aggregate_sme(
    df: DataFrame,
    *,
    excluded: Sequence[str] = tuple(schemas.EXCLUDED_REGIONS),
    keep_null_region: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Change intervals of every entity from its full snapshots."""
    return collapse_changes(
        registry_snapshots(df, excluded=excluded, keep_null_region=keep_null_region),
        "tin",
        "data_date",
        schemas.TRACKED_COLUMNS,
        backfill=["reg_number"],
        hot_rows=hot_rows,
    )


def merge_sme(
    state: DataFrame | None,
    new: DataFrame,
    history: Callable[[], DataFrame],
    *,
    excluded: Sequence[str] = tuple(schemas.EXCLUDED_REGIONS),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``aggregate_sme`` of all rows, from its ``state`` and the ``new`` extracted rows (``merge_snapshots``)."""
    return merge_snapshots(
        state,
        registry_snapshots(new, excluded=excluded),
        "tin",
        "data_date",
        schemas.TRACKED_COLUMNS,
        history=lambda: registry_snapshots(history(), excluded=excluded),
        backfill=["reg_number"],
        hot_rows=hot_rows,
    )


def fact_rows(
    df: DataFrame,
    measures: Sequence[str],
    *,
    key: str = "org_tin",
    width: int = 10,
    period: str = "data_date",
    corrected: str = "doc_date",
) -> DataFrame:
    """Yearly facts with padded numbers, all corrections of them."""
    return df.select(pad_id(key, width).alias("tin"), period, corrected, *measures)


def facts_of(
    latest: DataFrame, measures: Sequence[str], entities: DataFrame | None, period: str = "data_date", kind: str = "kind = 1"
) -> DataFrame:
    """The latest facts with their year, of entities of the given kind where these are given.

    Joined with distinct keys, because Spark would move a semi join ahead of picking the latest.
    """
    if entities is not None:
        latest = latest.join(entities.filter(kind).select("tin").distinct(), "tin")
    return latest.select("tin", F.year(period).alias("year"), *measures)


def yearly_facts(
    df: DataFrame,
    measures: Sequence[str],
    entities: DataFrame | None = None,
    *,
    key: str = "org_tin",
    width: int = 10,
    period: str = "data_date",
    corrected: str = "doc_date",
    kind: str = "kind = 1",
) -> DataFrame:
    """Latest correction per entity and period, with the period's year.

    With ``entities`` (stored, as it is read twice) only those of the given kind remain.  Facts of
    others go by a bitmap of the entities' numbers before anything is shuffled; the few that it
    lets pass meet the numbers themselves after the latest rows are picked, when an entity has no
    more rows than periods.
    """
    facts = fact_rows(df, measures, key=key, width=width, period=period, corrected=corrected)
    if entities is not None:
        facts = possible_keys(facts, "tin", entities.filter(kind), "tin")
    return facts_of(latest_per(facts, ["tin", period], corrected), measures, entities, period, kind)


def aggregate_revexp(df: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """Revenue and expenditure by organisation and year."""
    return yearly_facts(df, MEASURES["revexp"], entities)


def aggregate_empl(df: DataFrame, entities: DataFrame | None = None) -> DataFrame:
    """Number of employees by organisation and year."""
    return yearly_facts(df, MEASURES["empl"], entities)


def aggregate(df: DataFrame, dataset: str, entities: DataFrame | None = None) -> DataFrame:
    """Aggregate one of the table families by name."""
    schemas.check_dataset(dataset)
    if dataset == "sme":
        return aggregate_sme(df)
    return aggregate_revexp(df, entities) if dataset == "revexp" else aggregate_empl(df, entities)
