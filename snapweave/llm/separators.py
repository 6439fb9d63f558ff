"""Token counts of documents in flat token files without an index.

A flat file is one run of token ids, each document ended by a separator id; it comes in blocks
that begin and end anywhere.  Every block is searched for separators by itself, as one array
operation.  What a block needs from those before it (how many tokens, how many documents, where
the last separator was) is an associative sum, so a prefix scan in two levels stitches the
documents that cross borders: within runs of blocks, and over the runs of a file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapweave.llm.common import ship
from snapweave.llm.tokens import WORD_BPE, encoder
from snapweave.session import scratch_path, store

END = 65535
"""The separator: no id of the vocabulary, so that no text can contain it, whatever it spells."""

BLOCK = 1 << 16
"""Tokens in a block that is written."""

RUN = 1024
"""Blocks in a run of the prefix scan."""

ID = "<u2"
"""How ids are written; a vocabulary that reaches the separator is refused."""


def write_flat(docs: DataFrame, vocabulary: str = WORD_BPE, text: str = "text", block: int = BLOCK) -> DataFrame:
    """Whole texts as flat token files ``(file, block, tokens)``, one file a partition, stored.

    Documents follow each other in the order of the partition, a null or empty text being its
    separator alone.  ``tokens`` holds little-endian 16-bit ids.  Text that spells a token of the
    tokenizer's own, such as its end of text, is text like any.
    """
    if encoder(vocabulary).size() > END:
        raise ValueError(f"ids of this vocabulary reach the separator {END}")

    def flat(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, number, held, waiting = TaskContext.get().partitionId(), 0, [], 0
        encode, end = encoder(vocabulary).encode, np.array([END], ID)

        def blocks(ids: np.ndarray, first: int) -> pd.DataFrame:
            parts = [ids[at : at + block].tobytes() for at in range(0, len(ids), block)]
            return pd.DataFrame({"file": file, "block": range(first, first + len(parts)), "tokens": parts})

        for batch in batches:
            for value in batch["text"]:
                ids = np.frombuffer(encode(value), "<u4").astype(ID)
                held += [ids, end]
                waiting += len(ids) + 1
                if waiting >= 16 * block:
                    ids = np.concatenate(held)
                    whole = len(ids) // block * block
                    yield blocks(ids[:whole], number)
                    number, held = number + whole // block, [ids[whole:]]
                    waiting = len(held[0])
        if waiting:
            yield blocks(np.concatenate(held), number)

    spark = docs.sparkSession
    ship(spark)
    path = scratch_path(spark, "tokens")
    written = docs.select(F.col(text).alias("text")).mapInPandas(flat, "file long, block long, tokens binary")
    written.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(written.schema).parquet(path)


def count_tokens(blocks: DataFrame, end: int = END, run: int = RUN) -> DataFrame:
    """``(file, doc_no, start, n_tokens, ended)``: every document, in its file's order.

    ``blocks (file, block, tokens)`` number a file's blocks from 0; they may differ in length and
    be empty, a null one is empty.  ``n_tokens`` counts the separator; ``start`` is the place of
    the first token.  Tokens after a file's last separator are a document with ``ended`` false and
    only the tokens that are there.  Files without tokens, and empty tables, give no rows.
    """

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [np.frombuffer(t or b"", ID) for t in batch["tokens"]]
            ends = [np.flatnonzero(i == end) + 1 for i in ids]
            yield pd.DataFrame(
                {"file": batch["file"], "block": batch["block"], "n": [len(i) for i in ids], "ends": ends}
            )

    ship(blocks.sparkSession)
    found = blocks.select("file", "block", "tokens").mapInPandas(
        searched, "file long, block long, n long, ends array<long>"
    )
    # what the search finds is small and used twice
    found = store(found, "separators").withColumn("run", F.floor(F.col("block") / run))
    before = Window.partitionBy("file", "run").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("bigint")
    inside = found.withColumns(
        {
            "start": F.coalesce(F.sum("n").over(before), none),
            "docs": F.coalesce(F.sum(F.size("ends")).over(before), none),
        }
    )
    own_last = F.col("start") + F.try_element_at("ends", F.lit(-1))
    last = F.when(F.size("ends") > 0, own_last)
    inside = inside.withColumn("last", F.max(last).over(before))
    runs = inside.groupBy("file", "run").agg(
        F.sum("n").alias("run_n"), F.sum(F.size("ends")).alias("run_docs"), F.max(last).alias("run_last")
    )
    earlier = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumns(
        {
            "run_start": F.coalesce(F.sum("run_n").over(earlier), none),
            "docs_before": F.coalesce(F.sum("run_docs").over(earlier), none),
        }
    )
    absolute = F.col("run_start") + F.col("run_last")
    runs = runs.withColumn("last_before", F.coalesce(F.max(absolute).over(earlier), none))

    stitched = inside.join(runs.select("file", "run", "run_start", "docs_before", "last_before"), ["file", "run"])
    at = F.col("run_start") + F.col("start")
    begin = F.coalesce(F.col("run_start") + F.col("last"), F.col("last_before"))
    ended = stitched.select(
        "file",
        (F.col("docs_before") + F.col("docs")).alias("first_no"),
        begin.alias("begin"),
        at.alias("at"),
        "ends",
        F.posexplode("ends").alias("i", "end"),
    ).select(
        "file",
        (F.col("first_no") + F.col("i")).alias("doc_no"),
        F.when(F.col("i") == 0, F.col("begin")).otherwise(F.col("at") + F.get("ends", F.col("i") - 1)).alias("start"),
        (F.col("at") + F.col("end")).alias("stop"),
        F.lit(True).alias("ended"),
    )
    open_docs = (
        runs.groupBy("file")
        .agg(
            F.sum("run_docs").alias("doc_no"),
            F.coalesce(F.max(absolute), none).alias("start"),
            F.sum("run_n").alias("stop"),
        )
        .filter("stop > start")
        .withColumn("ended", F.lit(False))
    )
    return ended.unionByName(open_docs).select(
        "file", "doc_no", "start", (F.col("stop") - F.col("start")).alias("n_tokens"), "ended"
    )
