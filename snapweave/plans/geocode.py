"""Addresses to canonical places with codes and coordinates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapweave import schemas
from snapweave.functions.text import area_label, default_settlement, join_name_type, text_key
from snapweave.operators.fuzzy import Candidates, fuzzy_match, prepare_candidates
from snapweave.operators.intervals import recollapse
from snapweave.operators.lookups import abbreviation_dictionary, attach, expand_abbr
from snapweave.operators.skew import HOT_ROWS, SMALL_ROWS
from snapweave.operators.waterfall import Entries, Rung, prepare, waterfall_match
from snapweave.session import store, store_counted
from snapweave.sources.tables import read_lookup

# ---- fixed values: recipes in order of priority ------------------------------------------------

RUNGS = (
    Rung(
        "s",
        ("region", "district", "settlement_name", "settlement_type"),
        ("region", "municipality", "settlement", "type"),
    ),
    Rung(
        "s",
        ("region", "district_name", "settlement_name", "settlement_type"),
        ("region", "municipality", "settlement", "type"),
    ),
    Rung(
        "s",
        ("region", "city", "settlement_name", "settlement_type"),
        ("region", "municipality", "settlement", "type"),
    ),
    Rung(
        "s",
        ("region", "city_name", "settlement_name", "settlement_type"),
        ("region", "municipality", "settlement", "type"),
    ),
    Rung("s", ("region", "district", "settlement_name"), ("region", "municipality", "settlement")),
    Rung("s", ("region", "district_name", "settlement_name"), ("region", "municipality", "settlement")),
    Rung("s", ("region", "city", "settlement_name"), ("region", "municipality", "settlement")),
    Rung("s", ("region", "city_name", "settlement_name"), ("region", "municipality", "settlement")),
    Rung("s", ("region", "settlement_name", "settlement_type"), ("region", "settlement", "type")),
    Rung("s", ("region", "settlement_name"), ("region", "settlement")),
    Rung(
        "c",
        ("region", "district_name", "city_name", "settlement_name"),
        ("region", "area", "city", "settlement"),
    ),
    Rung("c", ("region", "district_name", "city_name"), ("region", "area", "city")),
    Rung("c", ("region", "city_name"), ("region", "city")),
    Rung("c", ("region", "city_name"), ("region", "area")),
)

# ---- end of fixed values -----------------------------------------------------------------------

_PARTS = ("region", "district", "city", "settlement")

# columns of a lookup row that go to the rows it matches
_PAYLOAD = [
    "geo_region", "place_region", "place_code", "place_iso",
    "place_area", "place_settlement", "place_type", "oktmo", "lat", "lon",
]


@dataclass(frozen=True)
class GeoLookups:
    """Lookup tables as read: abbreviations, regions, cities and settlements."""

    abbreviations: DataFrame
    regions: DataFrame
    cities: DataFrame
    settlements: DataFrame

    @staticmethod
    def read(
        spark: SparkSession,
        abbreviations: str,
        regions: str,
        cities: str | Sequence[str],
        settlements: str,
    ) -> GeoLookups:
        return GeoLookups(*[read_lookup(spark, p) for p in (abbreviations, regions, cities, settlements)])


def check_structure(columns: Sequence[str]) -> None:
    """The name columns of an address are mandatory, the type columns are not."""
    missing = [c for c in schemas.ADDRESS_COLUMNS if c.endswith("_name") and c not in columns]
    if missing:
        raise ValueError(f"not an address table, missing: {', '.join(missing)}")


def detect_mode(columns: Sequence[str]) -> str:
    """``chain`` for tables of the aggregate stage, ``standalone`` for any other address table."""
    return "chain" if set(schemas.SIGNATURE_COLUMNS) <= set(columns) else "standalone"


def fix_structure(df: DataFrame) -> DataFrame:
    """Add type columns that are missing, as nulls."""
    missing = [c for c in schemas.ADDRESS_COLUMNS if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in missing}) if missing else df


class Regions(NamedTuple):
    """The list of regions as names are compared with it, stored: by spelling and by number."""

    spelled: Candidates
    by_code: DataFrame


def prepare_regions(regions: DataFrame) -> Regions:
    listed = regions.select("code", "name", "short_name", "iso_code")
    by_code = listed.groupBy(F.col("code").try_cast("int").alias("__code")).agg(
        F.max(F.struct(*listed.columns)).alias("__coded")
    )
    return Regions(prepare_candidates(listed), store(by_code.dropna(subset="__code"), "regions_by_code"))


def canonical_regions(names: DataFrame, column: str, regions: DataFrame | Regions) -> DataFrame:
    """Each distinct region name with the region it means: name, canonical name and codes.

    A name made of digits is a region code.
    """
    made = regions if isinstance(regions, Regions) else prepare_regions(regions)
    spelled = fuzzy_match(names, column, made.spelled, words=schemas.REGION_TYPE_WORDS)
    numeric = F.col("name").rlike(r"^\d+$")
    found = attach(
        spelled.withColumn("__code", F.when(numeric, F.col("name").try_cast("int"))),
        made.by_code,
        "__code",
        checked=False,
        small=made.spelled.total <= SMALL_ROWS,
    ).withColumn("region", F.when(numeric, F.col("__coded")).otherwise(F.col("candidate")))
    return found.select(
        F.col("name").alias("raw_region"),
        F.col("region.name").alias("canonical"),
        F.col("region.code").alias("region_code"),
        F.col("region.iso_code").alias("region_iso_code"),
    )


def normalize_regions(df: DataFrame, column: str, regions: DataFrame) -> DataFrame:
    """Replace a region name by its canonical one and add its code and ISO code."""
    known = canonical_regions(df.select(column).distinct(), column, regions)
    return _with_region(df.drop("region_code", "region_iso_code"), column, known)


def _with_region(df: DataFrame, column: str, known: DataFrame, small: bool | None = None) -> DataFrame:
    right = known.withColumnRenamed("raw_region", "__raw")
    keyed = df.withColumn("__raw", F.col(column))
    return (
        attach(keyed, right, "__raw", checked=False, small=small)
        .withColumn(column, F.col("canonical"))
        .drop("__raw", "canonical")
    )


def _typed_addresses(df: DataFrame, dictionary: DataFrame, small: bool) -> DataFrame:
    """Raw addresses with expanded types and joined names; raw columns as ``raw_*``."""
    out = df.select("*", *[F.col(c).alias(f"raw_{c}") for c in schemas.ADDRESS_COLUMNS])
    for part in _PARTS:
        out = expand_abbr(out, f"{part}_type", dictionary, checked=False, small=small)
        out = out.withColumn(part, join_name_type(f"{part}_name", f"{part}_type"))
    return out


def cities_lookup(cities: DataFrame) -> DataFrame:
    """Cities with their place columns; areas that are themselves cities appear once more as such."""
    itself = F.coalesce(F.col("area_type") == "г", F.lit(False))
    area = F.when(~itself, F.col("area"))
    named = cities.select(
        F.concat_ws("/", "region", "area", "city", "settlement").alias("id"),
        "region", "area", "city", "settlement",
        F.col("region").alias("geo_region"),
        area_label(area, F.col("area_type")).alias("place_area"),
        F.coalesce("settlement", "city", "area").alias("place_settlement"),
        F.lit("г").alias("place_type"),
        "oktmo",
        F.col("geo_lat").try_cast("double").alias("lat"),
        F.col("geo_lon").try_cast("double").alias("lon"),
        itself.alias("itself"),
    )
    as_cities = named.filter(F.col("itself") & F.col("city").isNull()).withColumns(
        {"city": F.col("area"), "area": F.lit(None).cast("string")}
    )
    return named.unionByName(as_cities).drop("itself")


def settlements_lookup(settlements: DataFrame, dictionary: DataFrame, small: bool) -> DataFrame:
    """Settlements with expanded types and their place columns."""
    named = settlements.select(
        "id",
        "region", "municipality", "settlement", "type",
        F.col("region").alias("geo_region"),
        F.col("municipality").alias("place_area"),
        F.col("settlement").alias("place_settlement"),
        F.col("type").alias("place_type"),
        "oktmo",
        F.col("latitude_dd").try_cast("double").alias("lat"),
        F.col("longitude_dd").try_cast("double").alias("lon"),
    )
    return expand_abbr(named, "type", dictionary, checked=False, small=small)


def _as_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: text_key(c) for c in columns})


@dataclass(frozen=True)
class PreparedLookups:
    """Lookup tables shaped, keyed and stored, to be used by any number of ``geocode`` calls."""

    dictionary: DataFrame
    few_types: bool
    regions: Regions
    entries: Entries
    rungs: tuple[Rung, ...]


def prepare_lookups(lookups: GeoLookups, rungs: Sequence[Rung] = RUNGS) -> PreparedLookups:
    """Do all the work on lookup tables that does not depend on the addresses."""
    dictionary, types = store_counted(abbreviation_dictionary(lookups.abbreviations), "dictionary")
    few_types = types <= SMALL_ROWS
    cities = cities_lookup(lookups.cities)
    settlements = settlements_lookup(lookups.settlements, dictionary, few_types)
    regions = prepare_regions(lookups.regions)
    names = cities.select("region").unionByName(settlements.select("region"))
    known, spellings = store_counted(canonical_regions(names, "region", regions), "lookup_regions")
    few = spellings <= SMALL_ROWS

    def keyed(table: DataFrame, columns: Sequence[str]) -> DataFrame:
        """The lookup with canonical names in its keys, and those of the place beside them."""
        named = _with_region(table, "region", known, few).withColumnsRenamed(
            {"region_code": "place_code", "region_iso_code": "place_iso"}
        )
        return _as_keys(named.withColumn("place_region", F.col("region")), columns)

    tables = {
        "s": keyed(settlements, ["region", "municipality", "settlement", "type"]),
        "c": keyed(cities, ["region", "area", "city", "settlement"]),
    }
    return PreparedLookups(dictionary, few_types, regions, prepare(tables, rungs, payload=_PAYLOAD), tuple(rungs))


def geocode_addresses(df: DataFrame, lookups: PreparedLookups) -> DataFrame:
    """Every distinct raw address (``raw_*``) of ``df`` with its place, written once.

    All dictionary, name and lookup work is done on distinct addresses, for which ``df`` is read
    once.
    """
    distinct = store(fix_structure(df).select(*schemas.ADDRESS_COLUMNS).distinct(), "addresses")
    addresses = _typed_addresses(distinct, lookups.dictionary, lookups.few_types)
    known, spellings = store_counted(
        canonical_regions(addresses.select("region"), "region", lookups.regions), "regions"
    )
    few = spellings <= SMALL_ROWS

    raw = [f"raw_{c}" for c in schemas.ADDRESS_COLUMNS]
    own = _with_region(addresses, "region", known, few).withColumn("own_region", F.col("region"))
    keys = [c for part in _PARTS for c in (part, f"{part}_name", f"{part}_type")]
    matched = waterfall_match(_as_keys(own, keys), lookups.entries, lookups.rungs)
    from_place = F.col("geo_region").isNotNull()
    places = matched.select(
        *raw,
        F.when(from_place, F.col("place_iso")).otherwise(F.col("region_iso_code")).alias("region_iso_code"),
        F.when(from_place, F.col("place_code")).otherwise(F.col("region_code")).alias("region_code"),
        F.when(from_place, F.col("place_region")).otherwise(F.col("own_region")).alias("region"),
        F.col("place_area").alias("area"),
        F.col("place_settlement").alias("settlement"),
        F.col("place_type").alias("settlement_type"),
        "oktmo",
        "lat",
        "lon",
        "rung",
    )
    return store(
        places.withColumn(
            "settlement", default_settlement("region", "settlement", schemas.FEDERAL_CITIES)
        ),
        "places",
    )


def geocode(
    df: DataFrame,
    lookups: GeoLookups | PreparedLookups,
    *,
    mode: str | None = None,
    rungs: Sequence[Rung] = RUNGS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Replace raw address columns by place columns.

    Tables of the aggregate stage (``chain``) get the final columns, and intervals that no longer
    differ are merged.  Any other table keeps its rows and columns (``standalone``), but for the
    address columns and those that are named like a place column.  Lookups from
    ``prepare_lookups`` bring their own ``rungs``.
    """
    check_structure(df.columns)
    mode = mode or detect_mode(df.columns)
    table = fix_structure(df)
    made = lookups if isinstance(lookups, PreparedLookups) else prepare_lookups(lookups, rungs)
    places = geocode_addresses(df, made).drop("rung")
    raw = schemas.ADDRESS_COLUMNS
    kept = [c for c in df.columns if c not in raw and c not in schemas.GEO_COLUMNS]
    located = attach(
        table.select(*kept, *[F.col(c).alias(f"raw_{c}") for c in raw]),
        places,
        [f"raw_{c}" for c in raw],
        null_safe=True,
        checked=False,
    ).drop(*[f"raw_{c}" for c in raw])
    if mode == "standalone":
        return located
    return recollapse(
        located.select(*schemas.SME_GEOCODED.names),
        "tin",
        "start_date",
        "end_date",
        [*schemas.SIGNATURE_COLUMNS, *schemas.GEO_COLUMNS],
        hot_rows=hot_rows,
        counted=df,
    )
