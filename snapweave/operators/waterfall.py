"""Lookup join that tries one recipe of key columns after another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.operators.skew import SMALL_KEYS, same
from snapweave.session import store, store_counted


class Rung(NamedTuple):
    """One recipe: these columns of the left side equal those columns of that lookup."""

    source: str
    left: tuple[str, ...]
    right: tuple[str, ...]


class Entries(NamedTuple):
    """Lookup rows by recipe and key, each key once: what ``prepare`` makes of lookup tables."""

    table: DataFrame
    recipes: tuple[tuple[str, tuple[str, ...]], ...]
    payload: tuple[str, ...]
    small: bool


def _text(df: DataFrame, column: str) -> Column:
    """A key as text in which equal numbers look the same, whatever their type."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if not isinstance(kind, T.FractionalType):
        return c.cast("string")
    number = c.cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) < 1 << 53)
    return F.when(whole, F.floor(number).cast("string")).otherwise(number.cast("string"))


def _recipes(rungs: Sequence[Rung]) -> tuple[tuple[str, tuple[str, ...]], ...]:
    return tuple(dict.fromkeys((r.source, tuple(r.right)) for r in rungs))


def prepare(
    lookups: Mapping[str, DataFrame],
    rungs: Sequence[Rung],
    id: str = "id",
    payload: Sequence[str] = (),
    small: bool | None = None,
) -> Entries:
    """Enter every lookup row under the key of each recipe, drop keys that are not unique, and store.

    The result serves any number of ``waterfall_match`` calls.
    """
    recipes = _recipes(rungs)
    width = max(len(columns) for _, columns in recipes)

    def entries(source: str) -> DataFrame:
        table, keyed = lookups[source], []
        for number, (name, columns) in enumerate(recipes):
            if name == source:
                cells = [_text(table, c) for c in columns]
                cells += [F.lit(None).cast("string")] * (width - len(cells))
                key = F.struct(F.lit(number).alias("__recipe"), *[c.alias(f"__k{i}") for i, c in enumerate(cells)])
                whole = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in columns])
                keyed.append(F.when(whole, key) if len(columns) == 2 else key)
        return table.select(
            F.explode(F.array_compact(F.array(*keyed))).alias("__key"),
            F.col(id).cast("string").alias("geo_id"),
            F.lit(source).alias("source"),
            *payload,
        )

    every = reduce(DataFrame.unionByName, [entries(source) for source in dict.fromkeys(s for s, _ in recipes)])
    every, total = store_counted(every.select("__key.*", "geo_id", "source", *payload), "entries")
    keys = ["__recipe", *[f"__k{i}" for i in range(width)]]
    # counted by the key alone: numbers are summed by hash, rows would have to be sorted
    once = every.groupBy(*[F.col(k).alias(f"__once{k}") for k in keys]).count().filter("count = 1")
    if small is None:
        small = total <= SMALL_KEYS
    once = F.broadcast(once) if small else once
    unique = every.join(once, same(every, once, [(k, f"__once{k}") for k in keys]), "left_semi")
    return Entries(store(unique, "unique_entries"), recipes, tuple(payload), small)


def waterfall_match(
    addresses: DataFrame,
    lookups: Mapping[str, DataFrame] | Entries,
    rungs: Sequence[Rung],
    id: str = "id",
    payload: Sequence[str] = (),
    small: bool | None = None,
) -> DataFrame:
    """Match each distinct row of ``addresses`` with a lookup row by the first recipe that finds one.

    Adds ``geo_id`` (the lookup's ``id``), ``source`` and ``rung`` (1-based), all null without a
    match, and the ``payload`` columns of the matched lookup row.  Only lookup rows whose key
    occurs once take part; null parts of a key match null, except that two-part keys with a null
    are not used.  Equal numbers match, whatever their type.  Lookups that were counted as small
    are broadcast, recipe by recipe, and addresses never move.  Large ones meet a narrow table of
    address number, rung and key, of which the lowest rung goes back to its address.  ``small``
    says which where the caller has counted already; ``prepare`` does the lookups' part beforehand.
    """
    made = lookups if isinstance(lookups, Entries) else prepare(lookups, rungs, id, payload, small)
    found = ["geo_id", "source", *made.payload]
    width = len([c for c in made.table.columns if c.startswith("__k")])

    def keys(rung: Rung) -> list[Column]:
        cells = [_text(addresses, c) for c in rung.left]
        return cells + [F.lit(None).cast("string")] * (width - len(cells))

    numbered = [(n, rung, made.recipes.index((rung.source, tuple(rung.right)))) for n, rung in enumerate(rungs, 1)]
    if made.small:
        tried = addresses
        for n, rung, recipe in numbered:
            names = [f"__k{i}" for i in range(len(rung.left))]
            entry = made.table.filter(F.col("__recipe") == recipe).select(
                *[F.col(k).alias(f"__{n}{k}") for k in names], F.struct(*found).alias(f"__found{n}")
            )
            pairs = zip(keys(rung), names, strict=False)
            condition = reduce(lambda a, b: a & b, [key.eqNullSafe(F.col(f"__{n}{k}")) for key, k in pairs])
            tried = tried.join(F.broadcast(entry), condition, "left").drop(*[f"__{n}{k}" for k in names])
        hits = [F.when(F.col(f"__found{n}").isNotNull(), F.lit(n)) for n, _, _ in numbered]
        best = F.coalesce(*[F.col(f"__found{n}") for n, _, _ in numbered])
        return tried.select(*addresses.columns, best.alias("__found"), F.coalesce(*hits).alias("rung")).select(
            *addresses.columns, "__found.*", "rung"
        )

    rows = store(addresses.withColumn("__address", F.monotonically_increasing_id()), "addresses")
    attempts = [
        F.struct(F.lit(n).alias("__rung"), F.lit(recipe).alias("__of"), *[k.alias(f"__try{i}") for i, k in enumerate(keys(rung))])
        for n, rung, recipe in numbered
    ]
    tried = rows.select("__address", F.explode(F.array(*attempts)).alias("__t")).select("__address", "__t.*")
    table = store(made.table.withColumn("__entry", F.monotonically_increasing_id()), "numbered_entries")
    pairs = [("__of", "__recipe"), *[(f"__try{i}", f"__k{i}") for i in range(width)]]
    narrow = table.select("__recipe", *[f"__k{i}" for i in range(width)], "__entry")
    best = (
        tried.join(narrow, same(tried, narrow, pairs))
        .groupBy("__address")
        .agg(F.min_by("__entry", "__rung").alias("__entry"), F.min("__rung").alias("rung"))
    )
    matched = best.join(table.select("__entry", *found), "__entry").drop("__entry")
    return rows.join(matched, "__address", "left").select(*addresses.columns, *found, "rung")
