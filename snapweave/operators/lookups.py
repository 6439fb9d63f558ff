"""Joins with dictionaries and lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.operators.skew import as_list, broadcast_if_small, same


def first_per(df: DataFrame, key: str | Sequence[str], ordinal: str | Sequence[str]) -> DataFrame:
    """One row per key: the first in the order of ``ordinal``."""
    key, ordinal = as_list(key), as_list(ordinal)
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*ordinal)).alias("__row"))
    return picked.select(*key, "__row.*").select(*df.columns)


def unique_lookup(df: DataFrame, keys: str | Sequence[str], drop_null: bool = False) -> DataFrame:
    """Rows whose key occurs exactly once; all rows of a repeated key go.

    ``drop_null`` also drops keys with a null part.  Keys are counted by themselves, which takes a
    hash table of keys instead of a sort of whole rows; ``df`` is read twice.
    """
    keys = as_list(keys)
    if drop_null:
        df = df.dropna(subset=keys)
    once = df.groupBy(*[F.col(k).alias(f"__once_{k}") for k in keys]).count().filter("count = 1")
    return df.join(once, same(df, once, [(k, f"__once_{k}") for k in keys]), "left_semi")


def assert_many_to_one(right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Raise if a key occurs twice in ``right``, so that a join with it could add rows."""
    keys = as_list(keys)
    repeated = right.groupBy(*keys).count().filter("count > 1")
    if not repeated.isEmpty():
        raise ValueError(f"lookup rows are not unique by {keys}")
    return right


def is_unique(df: DataFrame, column: str) -> bool:
    """Whether a column names every row exactly once."""
    total, distinct = df.agg(F.count(F.lit(1)), F.count_distinct(column)).first()
    return total == distinct


def attach(
    df: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    *,
    null_safe: bool = False,
    checked: bool = True,
    small: bool | None = None,
) -> DataFrame:
    """Left join that keeps the number of rows; ``lookup`` is broadcast when counted as small.

    ``small`` says so where the caller has counted already; ``checked=False`` skips the test of
    unique keys for a lookup that was grouped by them.
    """
    on = as_list(on)
    if checked:
        assert_many_to_one(lookup if null_safe else lookup.dropna(subset=on), on)
    rest = [c for c in lookup.columns if c not in on]
    right = lookup.select(*[F.col(c).alias(f"__on_{i}") for i, c in enumerate(on)], *rest)
    if small is None:
        right = broadcast_if_small(right)
    elif small:
        right = F.broadcast(right)
    pairs = [(c, f"__on_{i}") for i, c in enumerate(on)]
    if null_safe:
        condition = same(df, right, pairs)
    else:
        condition = [df[a] == right[b] for a, b in pairs]
    return df.join(right, condition, "left").select(
        *[df[c] for c in df.columns], *[right[c] for c in rest]
    )


def abbreviation_dictionary(
    abbreviations: DataFrame,
    name: str = "name",
    full: str = "name_full",
    ordinal: str = "type_id",
) -> DataFrame:
    """Upper-case ``name`` → ``name_full`` from abbreviations, full forms and dotted abbreviations.

    Where a name has several meanings, the first wins: abbreviations before full forms before
    forms with an added dot, then by ``ordinal``.
    """
    n, f = F.col(name), F.col(full)
    forms = F.array_compact(
        F.array(
            F.struct(F.lit(0).alias("form"), n.alias("name")),
            F.struct(F.lit(1).alias("form"), f.alias("name")),
            F.when(
                ~n.endswith("."),
                F.struct(F.lit(2).alias("form"), F.concat(n, F.lit(".")).alias("name")),
            ),
        )
    )
    listed = abbreviations.select(
        F.explode(forms).alias("f"), f.alias("full"), F.col(ordinal).cast("long").alias("ordinal")
    ).select(
        F.upper("f.name").alias("name"), F.upper("full").alias("name_full"), "f.form", "ordinal"
    )
    return first_per(listed, "name", ["form", "ordinal", "name_full"]).select("name", "name_full")


def expand_abbr(
    df: DataFrame,
    column: str,
    dictionary: DataFrame,
    key: str = "name",
    value: str = "name_full",
    checked: bool = True,
    small: bool | None = None,
) -> DataFrame:
    """Replace an abbreviation, in any case, by its full form; unknown or missing becomes null."""
    entries = dictionary.select(
        F.col(key).alias("__abbr"), F.col(value).alias("__expanded")
    )
    keyed = df.withColumn("__abbr", F.upper(F.coalesce(F.col(column), F.lit(""))))
    joined = attach(keyed, entries, "__abbr", checked=checked, small=small)
    return joined.withColumn(column, F.col("__expanded")).drop("__abbr", "__expanded")


def code_lookup(
    df: DataFrame, column: str, lookup: DataFrame, code: str = "code", missing: str = "null"
) -> DataFrame:
    """Attach the lookup row with the same integer code, whatever the leading zeros.

    A code that is not found gives nulls, or with ``missing="error"`` an exception.
    """
    entries = lookup.withColumn("__code", F.col(code).try_cast("int"))
    if code in df.columns:
        entries = entries.drop(code)
    found = attach(
        df.withColumn("__code", F.col(column).try_cast("int")),
        entries.withColumn("__found", F.lit(True)),
        "__code",
    )
    if missing == "error" and not found.filter("__found IS NULL").isEmpty():
        raise KeyError(f"{column} holds codes that the lookup does not have")
    return found.drop("__code", "__found")
