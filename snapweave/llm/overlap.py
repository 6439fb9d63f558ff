"""Near-duplicates by word overlap: buckets propose pairs, the whole shingle sets decide.

Texts with the same set of shingles are one node.  A node enters one bucket for each band of its
MinHash, and those that the caller adds, such as its SimHash group.  Every two nodes that share a
bucket are compared by their complete sets, and link if their Jaccard similarity is high enough.

Nodes of a small bucket are joined in pairs.  Large buckets that share nodes form a crowd, whose
nodes are dealt into blocks; a task takes two blocks and finds the sizes of all intersections as
one matrix product, so that a crowd makes a row for each node and block, not for each pair.  Of
the links it finds, a task returns those that connect the same nodes, at most one for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.llm.common import lean, ship
from snapweave.llm.components import components
from snapweave.session import store

SHINGLE = 5
SIMILARITY = (4, 5)
"""The least Jaccard similarity that links, as a fraction."""

BANDS, WIDTH = 24, 5
"""A pair of similarity s meets in a bucket with probability 1 - (1 - s ** WIDTH) ** BANDS: 0.99993 at 0.8."""

HOT_BUCKET = 16
"""Nodes in a bucket up to which its pairs are joined one by one."""

CROWD_NODES, CROWD_SHINGLES = 2048, 1 << 22
"""Nodes, and shingles of all of them, in a block of a crowd, on average."""

_BLOCK = 2048
_COLUMNS = 4096
_FACTORS = np.random.default_rng(42).integers(1 << 62, (1 << 63) - 1, BANDS * WIDTH, np.uint64) * np.uint64(2) + np.uint64(1)
_SKETCH = T.StructType(
    [T.StructField("node", T.LongType()), T.StructField("n", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))]
)


def shingle_set(text: str | None) -> np.ndarray:
    """XXH64 of the different runs of ``SHINGLE`` words, sorted; of all words where there are fewer.

    Words are runs of anything but ASCII white space, A-Z in lower case.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    parts = [b" ".join(s) for s in zip(*(found[k:] for k in range(SHINGLE)))] or ([b" ".join(found)] if found else [])
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, parts), np.uint64, len(parts)))


def sketch(text: str | None) -> tuple[int, int, list[int]]:
    """``(node, n, bands)``: a digest of the set of shingles, its size, and a number for each band."""
    hashes = shingle_set(text)
    least = np.full(BANDS * WIDTH, (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), _BLOCK):
        mixed = hashes[at : at + _BLOCK, None] * _FACTORS
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        np.minimum(least, mixed.min(axis=0), out=least)
    bands = [xxhash.xxh64_intdigest(part.tobytes(), n) for n, part in enumerate(least.reshape(BANDS, WIDTH))]
    node = xxhash.xxh64_intdigest(hashes.tobytes())
    signed = np.array([node, *bands], np.uint64).view(np.int64).tolist()
    return signed[0], len(hashes), signed[1:]


@F.pandas_udf(_SKETCH)
def _sketches(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    lean()
    for batch in texts:
        yield pd.DataFrame([sketch(t) for t in batch], columns=["node", "n", "bands"])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _sets(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    lean()
    for batch in texts:
        yield pd.Series([shingle_set(t).view(np.int64) for t in batch], dtype=object)


def _links_between(a: list[np.ndarray], b: list[np.ndarray], may: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs that ``may`` link and whose sets are similar enough."""
    least, whole = SIMILARITY
    sizes = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    low, high = np.minimum.outer(*sizes), np.maximum.outer(*sizes)
    may = may & (low * whole >= high * least)
    if not may.any():
        return np.zeros(0, int), np.zeros(0, int)
    # only shingles on both sides count, a few thousand of them at a time
    left, right = np.concatenate(a), np.concatenate(b)
    both = np.intersect1d(left, right)
    common = np.zeros(may.shape, np.float32)
    row, other = np.repeat(np.arange(len(a)), sizes[0]), np.repeat(np.arange(len(b)), sizes[1])
    at, to = np.searchsorted(both, left), np.searchsorted(both, right)
    for column, values, rows in ((at, left, row), (to, right, other)):
        column[column == len(both)] = 0
        column[both[column] != values if len(both) else slice(None)] = -1
    for begin in range(0, len(both), _COLUMNS):
        sides = []
        for column, rows, n in ((at, row, len(a)), (to, other, len(b))):
            here = (column >= begin) & (column < begin + _COLUMNS)
            side = np.zeros((n, min(_COLUMNS, len(both) - begin)), np.float32)
            side[rows[here], column[here] - begin] = 1
            sides.append(side)
        common += sides[0] @ sides[1].T
    shared = common.astype(np.int64)
    return np.nonzero(may & (shared * whole >= (low + high - shared) * least))


def _connected(pairs: Iterator[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Those of the pairs that connect what was not connected yet."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            yield a, b


def _met(rows: list[tuple]) -> list[tuple[int, int]]:
    """Links of one task's rows ``(group, one, two, block, node, buckets, set)``."""
    one, two = rows[0][1:3]
    sides = [[r for r in rows if r[3] == block] for block in ([one] if one == two else [one, two])]
    left, right = sides[0], sides[-1]
    if not left or not right:
        return []
    may = np.zeros((len(left), len(right)), bool)
    numbered: dict[int, int] = {}
    spread = [
        [np.array([numbered.setdefault(v, len(numbered)) for v in r[5]]) for r in side] for side in (left, right)
    ]
    mine = np.full((len(left), max(map(len, spread[0]))), -1)
    theirs = np.full((len(right), max(map(len, spread[1]))), -2)
    for table, found in ((mine, spread[0]), (theirs, spread[1])):
        for n, values in enumerate(found):
            table[n, : len(values)] = values
    members: dict[int, list[int]] = {}
    for n, values in enumerate(theirs.tolist()):
        for v in values:
            members.setdefault(v, []).append(n)
    for n, values in enumerate(mine.tolist()):
        for v in values:
            if v in members:
                may[n, members[v]] = True
    if one == two:
        may = np.triu(may, 1)
    found = _links_between([r[6] for r in left], [r[6] for r in right], may)
    return list(_connected((left[i][4], right[j][4]) for i, j in zip(*(f.tolist() for f in found), strict=True)))


def _crowds(entries: DataFrame, large: DataFrame) -> DataFrame:
    """``(node, group, block, blocks)`` of the nodes in large buckets."""
    inside = entries.join(large, "bucket").groupBy("node", "n").agg(F.sort_array(F.collect_set("bucket")).alias("in"))
    inside = store(inside, "crowded")
    # a node's buckets as a chain; nodes with the same buckets give the same links, which are few
    chain = F.transform(F.sequence(F.lit(0), F.size("in") - 1), lambda i: F.struct(
        F.get("in", i).alias("a"), F.get("in", F.least(i + 1, F.size("in") - 1)).alias("b")
    ))
    links = inside.select(F.explode(chain).alias("l")).select("l.a", "l.b").distinct()
    groups = components(links).select(F.col("node").alias("bucket"), F.col("root").alias("group"))
    grouped = inside.select("node", "n", F.get("in", 0).alias("bucket")).join(groups, "bucket").drop("bucket")
    grouped = store(grouped, "crowds")
    sizes = grouped.groupBy("group").agg(
        F.greatest(
            F.ceil(F.count(F.lit(1)) / CROWD_NODES), F.ceil(F.sum("n") / CROWD_SHINGLES)
        ).alias("blocks")
    )
    block = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks"))
    return store(grouped.join(sizes, "group").select("node", "group", block.alias("block"), "blocks"), "blocks")


def _crowd_links(crowds: DataFrame, buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that connect all nodes of crowds which share a bucket and are similar enough."""
    told = crowds.join(buckets, "node").join(sets, "node")
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    dealt = told.withColumn("other", other).select(
        "group",
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        "block",
        "node",
        "buckets",
        "set",
    )

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []

        def links() -> pa.RecordBatch:
            found = _met(rows) if rows else []
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for batch in batches:
            plain = [c.to_pylist() for c in batch.columns[:5]]
            lists = [_lists(c) for c in batch.columns[5:]]
            for row in zip(*plain, *lists, strict=True):
                if row[:3] != current:
                    yield links()
                    current, rows = row[:3], []
                rows.append(row)
        yield links()

    key = ["group", "one", "two"]
    return dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(met, "a long, b long")


def _lists(column: pa.ListArray) -> list[np.ndarray]:
    """The lists of a column, each an array of its own."""
    values = column.flatten().to_numpy().copy()
    ends = np.cumsum(column.value_lengths().to_numpy())
    return np.split(values, ends[:-1])


def near_duplicates(docs: DataFrame, key: str, text: str = "text", proposed: DataFrame | None = None) -> DataFrame:
    """``(key, component)`` of every row: the smallest key its text is connected with.

    Texts link if the sets of their runs of five words have Jaccard similarity 0.8 or more and
    they share a bucket: one of ``BANDS`` bands, or a value of ``proposed (key, bucket)``.  Every
    pair that shares one is compared, however many there are.  Components are transitive.  Texts
    without words are alike.  ``docs`` is stored, its keys are whole numbers, unique and not null.
    Texts are read twice; those in proposed pairs and crowds are shuffled, once, to become sets.
    """
    ship(docs.sparkSession)
    made = docs.select(F.col(key).alias("key"), _sketches(F.col(text)).alias("s"))
    rows = store(made.select("key", "s.*"), "sketches")
    firsts = store(rows.groupBy("node").agg(F.min("key").alias("key")), "distinct_sets")
    nodes = rows.filter("n > 0").join(firsts.select("key"), "key", "left_semi").select("key", "node", "n", "bands")
    if proposed is None:
        nodes = nodes.withColumnRenamed("bands", "buckets")
    else:
        more = proposed.select(F.col(key).alias("key"), F.xxhash64("bucket", F.lit("proposed")).alias("more"))
        nodes = nodes.join(more, "key", "left").withColumn("buckets", F.array_compact(F.array_append("bands", F.col("more"))))
    nodes = store(nodes.select("node", "n", "buckets"), "nodes")

    entries = nodes.select("node", "n", F.explode("buckets").alias("bucket"))
    counted = store(entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "buckets")
    small = store(entries.join(counted.filter(F.col("members") <= HOT_BUCKET).select("bucket"), "bucket"), "small_buckets")
    other = small.select("bucket", F.col("node").alias("b"), F.col("n").alias("m"))
    least, whole = SIMILARITY
    near = F.least("n", "m") * whole >= F.greatest("n", "m") * least
    pairs = small.withColumnRenamed("node", "a").join(other, "bucket").filter("a < b").filter(near)
    pairs = store(pairs.select("a", "b").distinct(), "candidates")
    large = counted.filter(F.col("members") > HOT_BUCKET).select("bucket")
    crowds = None if large.isEmpty() else _crowds(entries, large)

    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    wanted = (wanted if crowds is None else wanted.union(crowds.select("node"))).distinct().join(firsts, "node")
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(wanted, "key")
    sets = store(texts.select("node", _sets("text").alias("set")), "sets")
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b"
    )
    common = F.size(F.array_intersect("x", "y"))
    links = both.filter(common * whole >= (F.size("x") + F.size("y") - common) * least).select("a", "b")
    if crowds is not None:
        links = links.union(_crowd_links(crowds, nodes.select("node", "buckets"), sets))
    linked = components(links).withColumnRenamed("root", "to")
    own = firsts.join(linked, "node", "left").select("node", "key", F.coalesce("to", "node").alias("to"))
    own = store(own, "members")
    smallest = own.groupBy("to").agg(F.min("key").alias("component"))
    whole_groups = store(own.join(smallest, "to").select("node", "component"), "components")
    return rows.select("key", "node").join(whole_groups, "node").select(F.col("key").alias(key), "component")
