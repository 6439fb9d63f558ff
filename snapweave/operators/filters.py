"""Row filters: exclusion patterns, entity membership, hierarchical codes, files already held."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.operators.skew import as_list, broadcast_if_small, same
from snapweave.session import materialize


def exclude_patterns(
    df: DataFrame, column: str, patterns: Sequence[str], keep_null: bool = False
) -> DataFrame:
    """Drop rows whose column contains one of the patterns, in any case.

    A null column is dropped as well unless ``keep_null``.
    """
    c = F.col(column)
    if not patterns:
        return df if keep_null else df.filter(c.isNotNull())
    found = reduce(lambda a, b: a | b, [c.ilike(f"%{p}%") for p in patterns])
    return df.filter(~found | c.isNull()) if keep_null else df.filter(~found)


def filter_entities(df: DataFrame, entities: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs among the entities (semi join).

    The entity side is reduced to its distinct keys before it is shuffled.
    """
    on = as_list(on)
    return df.join(entities.select(*on).distinct(), on, "left_semi")


def new_files(links: DataFrame, held: DataFrame, link: str = "link", path: str = "path") -> DataFrame:
    """Links whose file name (the part after the last slash) is not among the held paths."""
    names = held.select(F.substring_index(path, "/", -1).alias("__name")).distinct()
    return links.join(
        names, F.substring_index(links[link], "/", -1) == names["__name"], "left_anti"
    )


def expand_codes(
    classifier: DataFrame,
    codes: Sequence[str],
    group: str = "group",
    code: str = "code",
) -> DataFrame:
    """All codes meant by the given ones, in one column ``code``.

    A single capital letter means all codes of that group, anything else all codes starting
    with it.  A code the classifier does not know stands for itself; blanks are ignored.
    """
    wanted = list(dict.fromkeys(c.strip() for c in codes if c.strip()))
    g, c = F.col(group), F.col(code)
    meant = [
        F.when(g == w if len(w) == 1 and "A" <= w <= "Z" else c.startswith(w), F.lit(w))
        for w in wanted
    ]
    hits = classifier.select(
        c.alias("code"), F.explode(F.array_compact(F.array(*meant))).alias("__wanted")
    )
    unknown = (
        classifier.sparkSession.createDataFrame([(w,) for w in wanted], "__wanted string")
        .join(hits.select("__wanted").distinct(), "__wanted", "left_anti")
        .select(F.col("__wanted").alias("code"))
    )
    return hits.select("code").unionByName(unknown).filter(F.col("code") != "").distinct()


def filter_by_codes(
    df: DataFrame,
    column: str,
    codes: Sequence[str] | None,
    classifier: DataFrame,
    group: str = "group",
    code: str = "code",
) -> DataFrame:
    """Rows whose code is one of those meant by ``codes``; no codes, no filter."""
    if not [c for c in codes or () if c.strip()]:
        return df
    allowed = broadcast_if_small(materialize(expand_codes(classifier, codes, group, code)))
    return df.join(allowed, same(df, allowed, [(column, "code")]), "left_semi")


_BITMAP_BITS = 32_768  # of one bitmap, as Spark's bitmap functions make them
MAX_BITS = 1 << 28
"""Bits of all bitmaps of ``possible_keys`` together: 32 MB that are broadcast."""


def possible_keys(df: DataFrame, key: str, keys: DataFrame, key_of: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among the keys, ahead of any shuffle: all that are, and few others.

    A bit is set for the hash of each key, eight bits for a key; the bitmaps are broadcast and
    looked up row by row, so that an eighth of the other rows stays.  An exact join follows where
    that matters.  Beyond ``MAX_BITS`` / 2 keys a bitmap would keep too much, and ``df`` stays as it
    is.  Null keys go.  ``keys`` is counted, then read by the query.
    """
    count = keys.count()
    if 2 * count > MAX_BITS:
        return df
    maps = min(MAX_BITS, 8 * max(1, count)) // _BITMAP_BITS + 1

    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c.cast("string")), F.lit(maps * _BITMAP_BITS))

    at = place(F.col(key_of))
    bitmaps = (
        keys.filter(F.col(key_of).isNotNull())
        .groupBy(F.floor(at / _BITMAP_BITS).alias("__map"))
        .agg(F.bitmap_construct_agg(at % _BITMAP_BITS).alias("__bits"))
    )
    told = df.withColumn("__at", place(F.col(key))).withColumn("__map", F.floor(F.col("__at") / _BITMAP_BITS))
    bit = F.col("__at") % _BITMAP_BITS
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.get(F.array(*[byte.bitwiseAND(F.lit(1 << i)) for i in range(8)]), (bit % 8).cast("int")) != 0
    met = told.filter(F.col(key).isNotNull()).join(F.broadcast(bitmaps), "__map")
    return met.filter(is_set).select(*df.columns)
