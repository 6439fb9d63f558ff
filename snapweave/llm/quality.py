"""Quality rules: surface counts, and a log-likelihood ratio of hashed n-grams.

Words and pairs of neighbouring words are hashed into a fixed number of buckets.  One
pre-aggregated pass over the corpus counts the buckets twice, for all documents (the raw
multinomial) and for trusted ones (the target).  A document's score is the mean of
log2(target / raw) over its n-grams, shrunk towards 0 for short texts.  The logarithms are rounded
to fixed point, so every sum is an integer sum and the verdict does not depend on the order of
anything.

All of it is DataFrame functions.  A row is worked on where it is read: texts are never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapweave.llm.common import in_share, let, share_kept, words

BUCKETS = 16_384
SCALE = 1 << 20
"""Fixed point of the log ratios: this many units make one bit."""

SHRINK = 30
"""N-grams with ratio 1 that are added to every text before the mean is taken."""

MIN_SCORE = -0.07
"""Bits per n-gram below which a document reads unlike the trusted ones."""

TRUSTED_BOUND = 20_000
"""About so many trusted ids at most make the target; they are broadcast."""

_SYMBOLS = "[#*$%&|<>]"
_HAS_WORD = r"[^\x20\x09-\x0D]"


def _ngrams(hashes: Column) -> Column:
    """Buckets of all words and of all pairs of neighbours."""
    pairs = F.when(
        F.size(hashes) > 1,
        F.transform(
            F.sequence(F.lit(1), F.size(hashes) - 1),
            lambda i: F.xxhash64(F.get(hashes, i - 1), F.get(hashes, i)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    return F.transform(F.concat(hashes, pairs), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _repeated_words(hashes: Column) -> Column:
    """Words in 5-word windows that occur twice or more, told by 64-bit hashes of the windows."""
    windows = F.when(
        F.size(hashes) > 4,
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - 5),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(5)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def covered(places: Column) -> Column:
        walked = F.aggregate(
            places,
            F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-5).alias("last")),
            lambda a, p: F.struct((a.n + F.least(F.lit(5), p - a["last"])).alias("n"), p.alias("last")),
        )
        return walked.getField("n")

    def sorted_places(rows: Column) -> Column:
        twice = F.filter(
            rows,
            lambda x, i: F.coalesce(F.get(rows, i - 1).getField("h") == x.h, F.lit(False))
            | F.coalesce(F.get(rows, i + 1).getField("h") == x.h, F.lit(False)),
        )
        return F.sort_array(F.transform(twice, lambda x: x.at))

    def count(found: Column) -> Column:
        rows = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("bigint")).otherwise(
            let(rows, lambda r: let(sorted_places(r), covered))
        )

    return let(windows, count)


def log_ratios(docs: DataFrame, trusted: DataFrame, text: str = "text", doc_id: str = "doc_id") -> list[int]:
    """Fixed-point log2(target / raw) of every bucket, from whole texts of all documents.

    ``trusted`` has the ids of trusted documents, ``TRUSTED_BOUND`` of them by hash at most.  The
    result has ``BUCKETS`` numbers, whatever the size of the corpus.  Without trusted documents
    every ratio is 1.
    """
    ids = trusted.select(F.col(doc_id).alias("__id")).filter("__id is not null").distinct()
    kept = share_kept(ids.count(), TRUSTED_BOUND)
    ids = ids.filter(in_share(F.col("__id"), kept)).withColumn("__trusted", F.lit(1))
    grams = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text")).join(
        F.broadcast(ids), "__id", "left"
    )
    counts = (
        grams.select(
            F.coalesce("__trusted", F.lit(0)).alias("t"),
            F.explode(let(_hashes(words(F.col("__text"))), _ngrams)).alias("b"),
        )
        .groupBy("b")
        .agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target"))
        .collect()
    )
    raw, target = [1] * BUCKETS, [1] * BUCKETS
    for row in counts:
        raw[row.b] += row.raw
        target[row.b] += row.target
    all_raw, all_target = sum(raw), sum(target)
    if all_target == BUCKETS:
        return [0] * BUCKETS
    return [
        round((math.log2(t) - math.log2(r) + math.log2(all_raw) - math.log2(all_target)) * SCALE)
        for t, r in zip(target, raw, strict=True)
    ]


def quality(
    docs: DataFrame,
    ratios: list[int],
    text: str = "text",
    doc_id: str = "doc_id",
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """Counts, score and verdict of every document; one row out for each row in.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_grams, llr (bits per n-gram, shrunk), kept.  A null or empty text has no words: all counts
    0, base_failed true, llr 0, kept false.  Ties with ``min_score`` are kept.  Repeated rows and
    ids are judged one by one.  Other columns of ``docs`` are not read.  An empty table gives none.
    """
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<bigint>")

    def facts(found: Column) -> Column:
        def more(hashes: Column) -> Column:
            def scored(grams: Column) -> Column:
                total = F.aggregate(grams, F.lit(0).cast("bigint"), lambda a, b: a + F.get(table, b))
                return F.struct(F.size(grams).cast("bigint").alias("n_grams"), total.alias("sum"))

            return F.struct(
                _repeated_words(hashes).alias("n_repeat_words"),
                let(_ngrams(hashes), scored).alias("scored"),
            )

        return F.struct(
            F.size(found).cast("bigint").alias("n_words"),
            F.aggregate(found, F.lit(0).cast("bigint"), lambda a, w: a + F.length(w)).alias("word_chars"),
            let(_hashes(found), more).alias("more"),
        )

    def repeated(lines: Column) -> Column:
        return (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint")

    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike(_HAS_WORD))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("__text")
    ).select(
        "doc_id",
        F.regexp_count("__text", F.lit(_SYMBOLS)).cast("bigint").alias("n_symbols"),
        let(lines, repeated).alias("n_dup_lines"),
        let(words(F.col("__text")), facts).alias("f"),
    )
    least = F.lit(round(min_score * SCALE)).cast("bigint")
    n_words, n_repeat = F.col("f.n_words"), F.col("f.more.n_repeat_words")
    n_grams, total = F.col("f.more.scored.n_grams"), F.col("f.more.scored.sum")
    failed = (n_words < 10) | (100 * n_repeat > 20 * n_words)
    return rows.select(
        "doc_id",
        n_words.alias("n_words"),
        F.col("f.word_chars").alias("word_chars"),
        "n_symbols",
        "n_dup_lines",
        n_repeat.alias("n_repeat_words"),
        failed.alias("base_failed"),
        n_grams.alias("n_grams"),
        (total / (n_grams + SHRINK) / SCALE).alias("llr"),
        (~failed & (total >= least * (n_grams + SHRINK))).alias("kept"),
    )
