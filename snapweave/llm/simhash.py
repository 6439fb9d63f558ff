"""Near-duplicates by SimHash: multi-index hashing over the segments of a 64-bit fingerprint.

Two fingerprints that differ in at most ``bits`` bits differ in few bits of at least one segment.
Every distinct fingerprint is entered once in the table of each segment, looks up all values in a
small Hamming ball around its own segment, and complete distances decide.  A segment value that
many fingerprints share would give all pairs of them; the fingerprints that meet such a value are
linked otherwise, just as exactly: each lists the values within half the distance of its whole
fingerprint, two are close enough if and only if they list a common one, and only few distinct
fingerprints can list the same value.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.llm.common import lean, ship
from snapweave.llm.components import components
from snapweave.session import store

SEED = 42
SHINGLE = 3
BITS = 2
SEGMENTS = 2
HOT_BUCKET = 64
"""Distinct fingerprints with the same segment value up to which they are compared through the table."""


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a whole text; 0 without words.

    Words are runs of anything but ASCII white space, A-Z in lower case.  A bit is 1 if it is set
    in more than half of the shingles' XXH64, repeats included.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) < shingle:
        parts = [b" ".join(found)]
    else:
        parts = [b" ".join(s) for s in zip(*(found[k:] for k in range(shingle)))]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(p, SEED) for p in parts), np.uint64, len(parts))
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(parts), bitorder="little").view(np.int64)[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """``fingerprint`` of a column."""

    @F.pandas_udf(T.LongType())
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lean()
        for batch in texts:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    return found(text)


def fingerprint_hex(value: Column) -> Column:
    """16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _masks(bits: int, radius: int) -> Column:
    """All masks of ``bits`` bits with at most ``radius`` set, as a literal array."""
    sums = [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(bits), r)]
    return F.array(*[F.lit(s - (1 << 64) if s >> 63 else s).cast("bigint") for s in sums])


def _segment(value: Column, number: int, segments: int) -> Column:
    """The segment's bits, with its number above them."""
    low, high = 64 * number // segments, 64 * (number + 1) // segments
    bits = F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("bigint"))
    return bits.bitwiseOR(F.lit(number << 40).cast("bigint"))


def links(fingerprints: DataFrame, bits: int = BITS, segments: int = SEGMENTS) -> DataFrame:
    """Pairs ``(a, b)`` of different fingerprints that connect all within ``bits`` bits of each other.

    ``fingerprints (value)`` are distinct and stored.  Beyond hot segment values, every pair at
    that distance is there.  Under a hot value there may be fewer pairs, each of them that close,
    which connect the same fingerprints.  ``bits`` is even, 2 to 40 bits make a segment.
    """
    if bits % 2 or not 64 / 40 <= segments <= 32:
        raise ValueError("bits must be even and segments of 2 to 40 bits")
    # the first segments get the larger ball: if all of them are outside it, too many bits differ
    large, rest = divmod(bits, segments)
    balls = [large if n <= rest else large - 1 for n in range(segments)]
    used = [n for n in range(segments) if balls[n] >= 0]
    value = F.col("value")
    table = fingerprints.select(
        F.explode(F.array(*[_segment(value, n, segments) for n in used])).alias("key"), value.alias("b")
    )

    def ball(n: int) -> Column:
        own, width = _segment(value, n, segments), 64 * (n + 1) // segments - 64 * n // segments
        return F.transform(_masks(width, balls[n]), lambda mask: own.bitwiseXOR(mask))

    probes = fingerprints.select(F.explode(F.concat(*map(ball, used))).alias("key"), value.alias("a"))

    hot = store(table.groupBy("key").count().filter(F.col("count") > HOT_BUCKET).select("key"), "hot_values")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
    if hot.isEmpty():
        return probes.join(table, "key").filter(near).select("a", "b")
    cold = probes.join(hot, "key", "left_anti").join(table, "key").filter(near).select("a", "b")
    meeting = probes.join(hot, "key", "left_semi").select(F.col("a").alias("value")).distinct()
    listed = meeting.select(
        F.explode(F.transform(_masks(64, bits // 2), lambda m: value.bitwiseXOR(m))).alias("key"), "value"
    )
    stars = (
        listed.groupBy("key")
        .agg(F.collect_set("value").alias("values"))
        .filter(F.size("values") > 1)
        .select(F.array_min("values").alias("a"), F.explode("values").alias("b"))
        .filter("a != b")
    )
    return cold.union(stars)


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS, shingle: int = SHINGLE
) -> DataFrame:
    """``(key, fingerprint, component)`` of every row: the smallest key its text is connected with.

    Fingerprints link at ``bits`` or fewer differing bits; components are transitive.  Texts
    without words, null ones included, have fingerprint 0, which links like any other.  Repeated
    rows and keys give a row each; a null key gets its component's smallest key, null if there is
    none.  Other columns are not read.  An empty table gives no rows.  Fingerprints are stored
    (two numbers a row), so texts are read once and never shuffled.
    """
    ship(docs.sparkSession)
    rows = store(docs.select(F.col(key).alias("key"), fingerprints(F.col(text), shingle).alias("value")), "fingerprints")
    firsts = store(rows.groupBy("value").agg(F.min("key").alias("first")), "distinct_fingerprints")
    linked = components(links(firsts.select("value"), bits))
    linked = linked.withColumnRenamed("node", "value")
    least = store(
        linked.join(firsts, "value").groupBy("root").agg(F.min("first").alias("component")), "components"
    )
    own = linked.join(least, "root").select("value", "component")
    whole = store(
        firsts.join(own, "value", "left").select("value", F.coalesce("component", "first").alias("component")),
        "members",
    )
    return rows.join(whole, "value").select(
        F.col("key").alias(key), F.col("value").alias("fingerprint"), "component"
    )
