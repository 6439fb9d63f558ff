"""Substring dedup by content-defined chunking with a gear rolling hash.

A cut lies before a word whose rolling hash (of the bytes just before it) is smaller than those of
its neighbours, so cuts depend on nearby bytes alone: text inserted elsewhere moves no cut, and a
passage is cut alike in every document.  Chunks are told apart by a 64-bit digest.  A digest found
in two or more documents belongs to the first of them; in the others, neighbouring repeated chunks
are put together into spans.  The words on either side of a span are compared with those of the
document that has its outer chunk, so that the shared ends of a passage, which its chunks leave
out, count too; spans of enough words are reported.

One row for each chunk is stored, and one byte for each word.  Digests are counted with a pre-aggregated shuffle; a digest that
is everywhere is one row on either side of that count, and the join that follows may split it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.llm.common import ship
from snapweave.session import store

REACH = 3
"""A cut's hash is the smallest among so many words on either side: chunks average 2 * REACH + 1 words."""

WINDOW = 16
"""Bytes the rolling hash looks back, a power of two."""

MAX_WORDS = 16
"""Words after which a chunk ends anyway, where hashes tie (the same word over and over)."""

MIN_WORDS = 48
"""Words of the shortest span that is reported, with its ends."""

NOMINATED = 12
"""Words in whole chunks from which a span's ends are looked at."""

EDGE = 32
"""Words on either side of a span that are compared: no cut is further from a passage's end."""

#: One random number for each byte, by rule.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=2024) for b in range(256)], np.uint32)

_CHUNKS = "id long, row long, n int, start int, end int, words int, digest long, at int, strip binary"
_WHITE = b" \t\n\r\x0b\x0c"
_NO_ID = (1 << 63) - 1 - (1 << 53)
"""Numbers from here on stand for rows without an id."""


def cuts(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(places, words)``: byte places where chunks begin, and how many words each chunk has."""
    white = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.flatnonzero(~white & np.concatenate(([True], white[:-1])))
    if not len(begins):
        return begins, begins
    rolling = GEAR[data]
    width = 1
    while width < WINDOW:
        earlier = np.zeros_like(rolling)
        earlier[width:] = rolling[:-width] << np.uint32(width)
        rolling = rolling + earlier
        width *= 2
    before = np.where(begins > 0, rolling[begins - 1], np.uint32(0)) * np.uint32(2654435761)
    hashes = np.full(len(begins) + 2 * REACH, 1 << 32, np.int64)
    own = hashes[REACH : REACH + len(begins)]
    own[:] = before
    lowest = np.ones(len(begins), bool)
    for k in range(1, REACH + 1):
        lowest &= own < hashes[REACH - k : REACH - k + len(begins)]
        lowest &= own < hashes[REACH + k : REACH + k + len(begins)]
    lowest[0] = True
    at = np.flatnonzero(lowest)
    gaps = np.diff(np.append(at, len(begins)))
    if (gaps > MAX_WORDS).any():
        at = np.concatenate([np.arange(a, a + g, MAX_WORDS) for a, g in zip(at, gaps, strict=True)])
    return begins[at], np.diff(np.append(at, len(begins)))


def strip(text: str | None) -> bytes:
    """A byte of hash for each word: two words look alike by chance once in 256."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    return bytes([xxhash.xxh32_intdigest(w) & 255 for w in words])


def split(text: str | None) -> list[tuple[int, int, int, int, int]]:
    """``(n, start, end, words, digest)`` of a text's chunks.

    Offsets are code points; the white space at the end of a chunk is left out.  No words, no chunks.
    """
    raw = (text or "").encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    places, words = cuts(data)
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    ends = [*places[1:].tolist(), len(raw)]
    out = []
    for n, (begin, end, count) in enumerate(zip(places.tolist(), ends[: len(places)], words.tolist(), strict=True)):
        chunk = raw[begin:end].rstrip(_WHITE)
        value = xxhash.xxh64_intdigest(chunk)
        signed = value - (1 << 64) if value >> 63 else value
        out.append((n, int(points[begin]), int(points[begin + len(chunk)]), count, signed))
    return out


def _chunked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 500):
            part = batch.iloc[at : at + 500]
            found = [split(t) for t in part["text"]]
            counts = [len(f) for f in found]
            frame = pd.DataFrame([c for f in found for c in f], columns=["n", "start", "end", "words", "digest"])
            frame["id"] = np.repeat(part["id"].to_numpy(), counts)
            frame["row"] = np.repeat(part["row"].to_numpy(), counts)
            ahead = frame["words"].cumsum() - frame["words"]
            frame["at"] = ahead - np.repeat(ahead.to_numpy()[frame["n"].to_numpy() == 0], [c for c in counts if c])
            # the whole document's words stand with its first chunk
            strips = iter([strip(t) for t, c in zip(part["text"], counts, strict=True) if c])
            frame["strip"] = [next(strips) if n == 0 else None for n in frame["n"]]
            yield frame


@F.pandas_udf(T.IntegerType())
def _agree(mine: pd.Series, theirs: pd.Series) -> pd.Series:
    """How many bytes two strips have in common at their beginnings."""
    out = []
    for a, b in zip(mine, theirs, strict=True):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        out.append(n)
    return pd.Series(out, dtype="int32")


def _with_ends(spans: DataFrame, chunks: DataFrame, owners: DataFrame) -> DataFrame:
    """``spans`` with ``n_before`` and ``n_after``: the words around them that their owners have too."""
    left = owners.select(F.col("digest").alias("opening"), F.col("row").alias("left"), F.col("at").alias("left_at"))
    right = owners.select(
        F.col("digest").alias("closing"), F.col("row").alias("right"), (F.col("at") + F.col("words")).alias("right_at")
    )
    met = store(spans.join(left, "opening").join(right, "closing"), "spans")
    needed = met.select(F.explode(F.array("row", "left", "right")).alias("row")).distinct()
    strips = store(chunks.filter("n = 0").select("row", "strip").join(needed, "row"), "strips")

    def before(at: Column) -> Column:
        return F.reverse(F.hex(F.substring("strip", F.greatest(at - EDGE, F.lit(0)) + 1, F.least(at, F.lit(EDGE)))))

    def after(at: Column) -> Column:
        return F.hex(F.substring("strip", at + 1, F.lit(EDGE)))

    # of a strip only the few bytes beside the span go on from each join
    own = met.join(strips, "row").withColumns({"b": before(F.col("at")), "a": after(F.col("at") + F.col("n_words"))}).drop("strip")
    own = own.join(strips.withColumnRenamed("row", "left"), "left").withColumn("ob", before(F.col("left_at"))).drop("strip")
    own = own.join(strips.withColumnRenamed("row", "right"), "right").withColumn("oa", after(F.col("right_at"))).drop("strip")
    # two digits of hexadecimal spell a word
    return own.withColumns(
        {"n_before": F.floor(_agree("b", "ob") / 2).cast("long"), "n_after": F.floor(_agree("a", "oa") / 2).cast("long")}
    )


def repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """Passages of ``min_words`` words or more that an earlier document has too.

    Columns: doc_id, start, end (code points, end exclusive) and n_words of the passage's whole
    chunks, n_before and n_after (how many words on either side agree as well; these count for
    ``min_words``), n_chunks, first_doc_id (the smallest id that has one of the chunks).  The smallest
    doc_id that has a chunk keeps it; a document without id comes after all others.  Repetitions
    within one document, and between rows of the same id, are not reported.  Null and empty texts
    have none.  Other columns are not read.  Whole texts are chunked, once, and never shuffled; a
    byte for each word of the documents that share something is.  An empty table gives no rows.
    """
    ship(docs.sparkSession)
    row = F.monotonically_increasing_id()
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"), row.alias("row"))
    rows = rows.withColumn("id", F.coalesce("id", F.lit(_NO_ID) + F.col("row")))
    chunks = store(rows.mapInPandas(_chunked, _CHUNKS), "chunks")
    found = chunks.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    again = store(found.filter("first < last").select("digest", "first"), "repeated")
    shared = store(chunks.drop("strip").join(again, "digest"), "shared")
    # where the first document has it first; equal digests mean equally many words
    owners = shared.filter("id = first").groupBy("digest", "row", "words").agg(F.min("at").alias("at"))
    owners = owners.groupBy("digest").agg(F.min(F.struct("row", "at", "words")).alias("o")).select("digest", "o.*")
    in_row = Window.partitionBy("row").orderBy("n")
    first, last = F.min_by("digest", "n"), F.max_by("digest", "n")

    def named(key: str) -> Column:
        return F.when(F.col(key) < _NO_ID, F.col(key))

    spans = (
        shared.filter("id > first")
        .withColumn("island", F.col("n") - F.row_number().over(in_row))
        .groupBy("row", "island")
        .agg(
            F.first("id").alias("id"),
            F.min("start").cast("long").alias("start"),
            F.max("end").cast("long").alias("end"),
            F.sum("words").alias("n_words"),
            F.count(F.lit(1)).alias("n_chunks"),
            F.min("first").alias("first"),
            F.min("at").alias("at"),
            first.alias("opening"),
            last.alias("closing"),
        )
        .filter(F.col("n_words") >= min(min_words, NOMINATED))
    )
    whole = _with_ends(spans, chunks, owners)
    return whole.filter(F.col("n_words") + F.col("n_before") + F.col("n_after") >= min_words).select(
        named("id").alias("doc_id"), "start", "end", "n_words", "n_before", "n_after", "n_chunks",
        named("first").alias("first_doc_id"),
    )
