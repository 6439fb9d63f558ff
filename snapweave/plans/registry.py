"""The whole way from archives to the yearly panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapweave import schemas
from snapweave.operators.filters import new_files
from snapweave.operators.incremental import merge_latest
from snapweave.operators.panel import panelize
from snapweave.operators.skew import HOT_ROWS
from snapweave.plans.aggregate import (
    MEASURES, aggregate_empl, aggregate_revexp, aggregate_sme, fact_rows, facts_of, merge_sme,
)
from snapweave.plans.extract import extract_new, read_extracted
from snapweave.plans.geocode import GeoLookups, PreparedLookups, geocode
from snapweave.plans.state import Versions
from snapweave.session import store
from snapweave.sources.links import dataset_links
from snapweave.sources.sinks import write_parquet


def new_links(pages: DataFrame, held: DataFrame, expected: Mapping[int, str] | None = None) -> DataFrame:
    """Data links of dataset pages whose files are not among the held ``path``s."""
    return new_files(dataset_links(pages, expected or schemas.DATASET_PAGE_ROWS), held)


def _facts(aggregated: DataFrame, revexp: DataFrame | None, empl: DataFrame | None) -> dict[str, DataFrame]:
    facts = {}
    if revexp is not None:
        facts["revexp"] = aggregate_revexp(revexp, aggregated)
    if empl is not None:
        facts["empl"] = aggregate_empl(empl, aggregated)
    return facts


def registry_panel(
    sme: DataFrame,
    lookups: GeoLookups,
    revexp: DataFrame | None = None,
    empl: DataFrame | None = None,
    *,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Extracted tables to the panel: aggregate, geocode, panelize.

    The aggregated registry is written once, because both the facts and the geocoder read it.
    """
    aggregated = store(aggregate_sme(sme, hot_rows=hot_rows), "aggregated")
    facts = _facts(aggregated, revexp, empl)
    geocoded = geocode(aggregated, lookups, hot_rows=hot_rows)
    return panelize(geocoded, list(facts.values()), few_per_key=True)


def process_incremental(
    spark: SparkSession,
    folders: Mapping[str, str],
    lookups: GeoLookups | PreparedLookups,
    work: str,
    *,
    codes: Sequence[str] | None = None,
    classifier: DataFrame | None = None,
    files_per_batch: int | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``process`` for archives that keep coming: each call merges the new ones into a kept state.

    ``state`` below ``work`` holds the intervals of the registry, the latest fact of each period, and
    which archives they come from, in versions (``plans.state``): a call that fails leaves the last
    one in force, and the next call merges what is still missing.  Extracted rows of earlier
    archives are not read again, but for entities whose snapshots come late (``merge_snapshots``).
    Geocoding and the panel work on the merged intervals; ``geocoded`` and ``panel`` are replaced.
    """
    root = work.rstrip("/")
    versions = Versions(spark, f"{root}/state")
    done, tables = versions.read("archives"), {}
    taken = {(r["dataset"], r["archive"]) for r in done.collect()} if done is not None else set()
    listed = set(taken)
    for name, folder in folders.items():
        target = f"{root}/extracted/{name}"
        extract_new(
            spark, folder, target, f"{root}/ledger/{name}", name,
            codes=codes, classifier=classifier, files_per_batch=files_per_batch,
            rejects=f"{root}/rejects/{name}",
        )
        rows = read_extracted(spark, target, name, archive=True)
        fresh = [r["archive"] for r in rows.select("archive").distinct().collect() if (name, r["archive"]) not in taken]
        listed |= {(name, archive) for archive in fresh}
        before = versions.read(name)
        if fresh or before is None:
            # the folder is partitioned by archive, so that others are not opened
            new = rows.filter(F.col("archive").isin(fresh)).drop("archive")
            if name == "sme":
                tables[name] = merge_sme(before, new, lambda r=rows: r.drop("archive"), hot_rows=hot_rows)
            else:
                facts = fact_rows(new, MEASURES[name])
                tables[name] = merge_latest(before, facts, ["tin", "data_date"], "doc_date")
        else:
            tables[name] = before
    if listed != taken or done is None:
        archives = spark.createDataFrame(sorted(listed), "dataset string, archive string")
        versions.commit({**tables, "archives": archives})

    intervals = versions.read("sme").select(*schemas.SME_AGGREGATED.names)
    facts = [facts_of(versions.read(n), MEASURES[n], intervals) for n in folders if n != "sme"]
    geocoded = geocode(intervals, lookups, hot_rows=hot_rows)
    write_parquet(geocoded, f"{root}/geocoded")
    geocoded = spark.read.schema(geocoded.schema).parquet(f"{root}/geocoded")
    panel = panelize(geocoded, facts, few_per_key=True)
    write_parquet(panel, f"{root}/panel", partition_by=["year"])
    return spark.read.schema(panel.schema).parquet(f"{root}/panel").select(*panel.columns)


def process(
    spark: SparkSession,
    folders: Mapping[str, str],
    lookups: GeoLookups,
    work: str,
    *,
    codes: Sequence[str] | None = None,
    classifier: DataFrame | None = None,
    files_per_batch: int | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Archives to the panel; ``folders`` names the archive folder of each dataset at hand.

    Extracted tables gather below ``work``, so a later call reads new archives only.  Every other
    stage is replaced by its new result: ``aggregated/<dataset>``, ``geocoded``, and ``panel`` by
    year; ``rejects/<dataset>`` lists what could not be read.
    """
    root = work.rstrip("/")
    tables = {}
    for name, folder in folders.items():
        target = f"{root}/extracted/{name}"
        extract_new(
            spark, folder, target, f"{root}/ledger/{name}", name,
            codes=codes, classifier=classifier, files_per_batch=files_per_batch,
            rejects=f"{root}/rejects/{name}",
        )
        tables[name] = read_extracted(spark, target, name)

    def staged(df: DataFrame, name: str) -> DataFrame:
        write_parquet(df, f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    aggregated = staged(aggregate_sme(tables["sme"], hot_rows=hot_rows), "aggregated/sme")
    facts = _facts(aggregated, tables.get("revexp"), tables.get("empl"))
    facts = [staged(df, f"aggregated/{name}") for name, df in facts.items()]
    geocoded = staged(geocode(aggregated, lookups, hot_rows=hot_rows), "geocoded")
    panel = panelize(geocoded, facts, few_per_key=True)
    write_parquet(panel, f"{root}/panel", partition_by=["year"])
    # the partition column comes last from the folder
    return spark.read.schema(panel.schema).parquet(f"{root}/panel").select(*panel.columns)
