"""Packing documents into sequences: first-fit decreasing in random groups.

Documents are tokenised once, where they are read, and cut into full sequences and a rest.  Only
the pieces' numbers move: they are dealt at random into groups of a few thousand, and each group
is packed by itself, the largest piece first, into the first sequence with room.  A tournament
tree over the sequences' free room finds that one in a logarithm of their number.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapweave.llm.common import ship, trim
from snapweave.llm.tokens import ID_BYTES, WORD_BPE, encoder
from snapweave.session import store

CAPACITY = 2048
END = 1
GROUP = 8192
"""Pieces in a group, on average."""

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, int, int]]:
    """``(start, length, crc32)`` of consecutive pieces, all but the last of them full."""
    step = capacity * ID_BYTES
    return [
        (at // ID_BYTES, len(part) // ID_BYTES, zlib.crc32(part))
        for at in range(0, len(ids), step)
        for part in (ids[at : at + step],)
    ]


def pieces(docs: DataFrame, vocabulary: str = WORD_BPE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All pieces of all documents, from whole texts."""
    end = struct.pack("<I", END)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        encode = encoder(vocabulary).encode
        for batch in batches:
            rows = []
            # a text at a time, as the bytes that it came in
            for key, value in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = encode(value.as_py()) + end
                rows += [(key.as_py(), *piece, len(ids) // ID_BYTES) for piece in cut(ids)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

    ship(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return narrow.mapInArrow(tokenised, _PIECES)


def first_fit_decreasing(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """``(bin, offset)`` for each length; lengths lie between 1 and ``capacity``.

    The longest come first, equal ones in the order given; each goes to the lowest bin with room.
    """
    leaves = 1 << max(0, len(lengths) - 1).bit_length()
    room = [capacity] * (2 * leaves)  # room[n] is the most room below node n
    placed: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need, node = lengths[item], 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        placed[item] = (node - leaves, capacity - room[node])
        room[node] -= need
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return placed


def pack(docs: DataFrame, vocabulary: str = WORD_BPE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document ends with the end token; a null or empty text is that token alone.  Repeated
    rows are packed as often as they come, a null id stays null.  Other columns are not read.  An
    empty table gives no rows.  Pieces are stored, a few numbers each; texts are never shuffled.
    Which group a piece goes to depends on its numbers alone, so reruns agree.
    """
    cut_up = store(pieces(docs, vocabulary, text, doc_id), "pieces")
    groups = max(1, math.ceil(cut_up.count() / GROUP))

    def packed(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        places = first_fit_decreasing(rows["length"].tolist())
        rows["sequence_id"] = rows["__group"] * (1 << 32) + [b for b, _ in places]
        rows["offset"] = [o for _, o in places]
        return rows.drop(columns="__group")

    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups))
    text_id = F.col("doc_id").cast("string").alias("doc_id")
    numbered = cut_up.select(text_id, "start", "length", "ids_crc32", "doc_tokens", group.alias("__group"))
    return (
        numbered.groupBy("__group")
        .applyInPandas(
            packed,
            "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
        )
        .withColumn("doc_id", F.col("doc_id").cast("bigint"))
    )
