"""Merkle fixity audit of web archives: find what differs between two replicas.

Every record is hashed.  Records whose offsets lie in the same range of a file make a leaf of the
file's tree, over (offset, length, hash) in their order; each level above hashes a fixed number of
consecutive ranges.  An audit compares the files' roots, then only the children of nodes that
differ, level by level, and only records of differing leaves: for replicas that agree, nothing but
their roots is read.  Nodes are rows, so a level is one shuffle whatever the size of a file; what differs
on a level is stored before its children are looked up.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapweave.llm.common import ship
from snapweave.session import scratch_path, store

RANGE = 1 << 16
"""Bytes of a file that make a leaf."""

FAN_OUT = 16
RECORDS_A_FILE = 2048


def split_records(data: bytes) -> list[tuple[int, bytes]]:
    """``(offset, record)`` of an uncompressed archive file; bytes that are no record end it as one."""
    out, at = [], 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        lines = data[at : max(head, at)].split(b"\r\n")
        lengths = [v for n, _, v in (line.partition(b":") for line in lines) if n.strip().lower() == b"content-length"]
        length = lengths[0].strip() if lengths else b""
        end = head + 8 + int(length) if head >= 0 and length.isdigit() else len(data)
        out.append((at, data[at : min(end, len(data))]))
        at = end
    return out


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``(file, offset, record)`` of the files at ``path``, gzip or not; a file fits one row (2 GB).

    Offsets of compressed files are those of the uncompressed data.  Records are told apart by
    Content-Length; what follows damage that hides a record's length is one record.
    """

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"], strict=True):
                data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
                found = split_records(data)
                yield pd.DataFrame(
                    {"file": file, "offset": [o for o, _ in found], "record": [r for _, r in found]}
                )

    ship(spark)
    files = spark.read.format("binaryFile").load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return named.mapInPandas(records, "file string, offset long, record binary")


def as_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages as the records of an archive ``(file, offset, record, page_id)``.

    Files hold ``RECORDS_A_FILE`` consecutive page ids, in the order of ids; pages without id are
    dealt by hash into files of their own.  A null page or address is an empty one.
    """
    body, address = F.coalesce(html, F.lit("")), F.coalesce(url, F.lit(""))
    number = F.floor(F.col(page_id) / RECORDS_A_FILE)
    loose = F.concat(F.lit("loose-"), F.pmod(F.xxhash64(url, html), F.lit(1 << 20)).cast("string"))
    file = F.concat(F.coalesce(F.concat(F.lit("part-"), number.cast("string")), loose), F.lit(".warc"))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "),
        address,
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    record = F.concat(head, body, F.lit("\r\n\r\n")).cast("binary")
    rows = pages.select(file.alias("file"), F.col(page_id).alias("page_id"), record.alias("record"))
    order = Window.partitionBy("file").orderBy("page_id", F.xxhash64("record"))
    before = F.sum(F.length("record")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return rows.select("file", F.coalesce(before, F.lit(0).cast("bigint")).alias("offset"), "record", "page_id")


def leaves(records: DataFrame) -> DataFrame:
    """``(file, offset, length, digest)`` of every record; a null record counts as an empty one."""
    content = F.coalesce("record", F.lit(b""))
    return records.select(
        "file", "offset", F.length(content).cast("bigint").alias("length"), F.unhex(F.sha2(content, 256)).alias("digest")
    )


def _hash(children: Column) -> Column:
    """Digest over a node's children, given as structs whose first field is their place."""
    lines = F.transform(
        F.sort_array(children), lambda c: F.concat_ws(":", c.place, c.length, F.hex(c.digest))
    )
    return F.unhex(F.sha2(F.array_join(lines, ",").cast("binary"), 256))


class Tree:
    """A stored tree: ``records`` (the leaves' rows) and ``nodes (level, file, node, digest)``."""

    def __init__(self, records: DataFrame, nodes: DataFrame, levels: int):
        self.records, self.nodes, self.levels = records, nodes, levels

    def level(self, number: int) -> DataFrame:
        return self.nodes.filter(F.col("level") == number).select("file", "node", "digest")


def build(records: DataFrame, span: int = RANGE, fan_out: int = FAN_OUT) -> Tree:
    """Hash ``records (file, offset, record)`` into one tree for each file.

    All columns but these are ignored.  Records are hashed where they are read; only digests move.
    The number of levels follows the longest file, so that each file ends in one root.  A level is
    written before the next is built from it.
    """
    spark = records.sparkSession
    path = scratch_path(spark, "tree")
    hashed = leaves(records.filter("file is not null and offset is not null"))
    hashed.write.parquet(f"{path}/records")
    rows = spark.read.schema(hashed.schema).parquet(f"{path}/records")
    furthest = rows.agg(F.max("offset")).first()[0] or 0

    child = F.struct(F.col("offset").alias("place"), "length", "digest")
    level = rows.groupBy("file", F.floor(F.col("offset") / span).alias("node")).agg(
        _hash(F.collect_list(child)).alias("digest")
    )
    schema, number, nodes = "file string, node long, digest binary", 0, furthest // span + 1
    while True:
        level.write.parquet(f"{path}/nodes/level={number}")
        if nodes == 1:
            break
        child = F.struct(F.col("node").alias("place"), F.lit(0).alias("length"), "digest")
        level = (
            spark.read.schema(schema)
            .parquet(f"{path}/nodes/level={number}")
            .groupBy("file", F.floor(F.col("node") / fan_out).alias("parent"))
            .agg(_hash(F.collect_list(child)).alias("digest"))
            .withColumnRenamed("parent", "node")
        )
        number, nodes = number + 1, (nodes - 1) // fan_out + 1
    return Tree(rows, spark.read.schema(f"{schema}, level int").parquet(f"{path}/nodes"), number + 1)


def _differing(ours: DataFrame, theirs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose value differs, or that one side lacks."""
    other = theirs.withColumnRenamed(value, "__other")
    return ours.join(other, keys, "full").filter(~F.col(value).eqNullSafe(F.col("__other"))).select(*keys)


def audit(ours: Tree, theirs: Tree, span: int = RANGE, fan_out: int = FAN_OUT) -> DataFrame:
    """``(file, offset, length, status)`` of every record that differs between two trees.

    ``status`` is ``changed`` (other bytes at that offset), ``missing`` (only ours has one there)
    or ``extra`` (only theirs); ``length`` is ours, theirs for an extra record.  Trees of different
    height are compared from the lower one's root level.  Equal replicas and empty ones give no
    rows.  Rows of one side that repeat file and offset are compared together.
    """
    number = min(ours.levels, theirs.levels) - 1
    differing = store(_differing(ours.level(number), theirs.level(number), ["file", "node"], "digest"), "differing")
    while number > 0 and not differing.isEmpty():
        number -= 1
        parent = differing.select("file", F.col("node").alias("parent"))

        def below(tree: Tree, number: int = number, parent: DataFrame = parent) -> DataFrame:
            nodes = tree.level(number).withColumn("parent", F.floor(F.col("node") / fan_out))
            return nodes.join(parent, ["file", "parent"], "left_semi").drop("parent")

        differing = store(_differing(below(ours), below(theirs), ["file", "node"], "digest"), "differing")

    def among(tree: Tree) -> DataFrame:
        rows = tree.records.withColumn("node", F.floor(F.col("offset") / span))
        return rows.join(differing, ["file", "node"], "left_semi").drop("node")

    def at_offset(tree: Tree, length: str, digests: str) -> DataFrame:
        digest = F.sort_array(F.collect_list("digest")).alias(digests)
        return among(tree).groupBy("file", "offset").agg(F.max("length").alias(length), digest)

    here, there = at_offset(ours, "length", "digest"), at_offset(theirs, "other_length", "other")
    both = here.join(there, ["file", "offset"], "full").filter(~F.col("digest").eqNullSafe(F.col("other")))
    status = F.when(F.col("other").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("changed")
    return both.select("file", "offset", F.coalesce("length", "other_length").alias("length"), status.alias("status"))
