"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; its
result is written and read again as the next one's ``docs``.  All stages but the last return the
columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapweave.llm import language, mixing, overlap, packing, secrets, simhash
from snapweave.operators.skew import SMALL_ROWS
from snapweave.session import store


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose text is in one of the learned languages.

    Texts without a letter go, and those that cost clearly more bits a byte in the best language
    than labelled documents do.  Without a labelled document nothing can be told: a ValueError.
    """
    model = language.train(docs)
    if not model.languages:
        if docs.isEmpty():
            return docs
        raise ValueError("no document with a language to learn from")
    usual = language.usual_bits(docs, model)
    found = language.identify(docs, model, name="__predicted")
    told = F.col("__predicted.lang_pred") != language.UNKNOWN
    junk = language.is_junk(F.col("text"), F.col("__predicted.bits"), usual)
    return found.filter(told & ~junk).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: the smallest doc_id, the first row where ids repeat or are null.

    SimHash of runs of five words proposes groups within two bits, MinHash bands those that differ
    in more; of what is proposed, texts group that have four fifths of these runs in common.
    """
    rows = store(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    alike = simhash.near_duplicates(rows, key="__row", shingle=overlap.SHINGLE)
    proposed = alike.select("__row", F.col("component").alias("bucket"))
    groups = store(overlap.near_duplicates(rows, key="__row", proposed=proposed), "groups")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row")
    stays = (
        groups.join(rows.select("__row", "doc_id"), "__row").groupBy("component").agg(F.min(order).alias("best"))
    )
    goes = store(groups.select("__row").join(stays.select("best.__row"), "__row", "left_anti"), "goes")
    if goes.count() <= SMALL_ROWS:
        goes = F.broadcast(goes)
    return rows.join(goes, "__row", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by its kind; n_chars follows the text."""
    masked = secrets.redact(docs.withColumn("__length", F.length("text")))
    changed = F.length("text") != F.col("__length")
    return masked.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))).select(
        *[F.col(c).cast(t) for c, t in docs.dtypes]
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that every source meets its target weight."""
    sized = docs.select(
        F.struct(*docs.columns).alias("__doc"), "source", mixing.count_words(F.col("text")).alias("size")
    )
    copied = mixing.mix(sized).filter("copies > 0")
    return copied.select("__doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("__doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in a training sequence."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None
"""SQL has neither the model nor the tokenizer; the tests hold the stages against plain Python."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
