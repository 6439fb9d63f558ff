"""Registered queries of this subpackage, ``opN_<name>``, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapweave.llm import chat, chunks, language, merkle, mixing, packing, repair, secrets, separators, simhash, vafile, whitening
from snapweave.llm import quality as quality_rules
from snapweave.llm.common import read
from snapweave.session import store


def op1_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return vafile.search(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_merkle_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The pages as an archive, held against a replica with altered and lost records."""
    archive = store(merkle.as_records(read(spark, folder, "pages")), "archive")
    altered = F.concat(F.lit("warc").cast("binary"), F.substring("record", 5, (1 << 31) - 1))
    replica = archive.filter("page_id is null or page_id % 997 != 11").withColumn(
        "record", F.when(F.col("page_id") % 499 == 7, altered).otherwise(F.col("record"))
    )
    return merkle.audit(merkle.build(archive), merkle.build(replica))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    trusted = read(spark, folder, "labels").filter("quality = 1 and toxic = 0")
    ratios = quality_rules.log_ratios(docs, trusted)
    return quality_rules.quality(docs, ratios)


def op4_chunk_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chunks.repeats(read(spark, folder, "documents"))


def op5_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda s: s.rule < len(secrets.BASE))

    def of(kind: int):
        return F.size(F.filter(spans, lambda s: s.rule == kind)).cast("bigint")

    return secrets.find_secrets(docs).select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(spans).alias("spans"),
    )


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.train(docs))
    return found.select(
        "doc_id",
        language.held_out(F.col("doc_id")).alias("held_out"),
        F.col("predicted.lang_pred").alias("lang_pred"),
        F.col("predicted.score").alias("score"),
        F.col("predicted.bits").alias("bits"),
    )


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return separators.count_tokens(separators.write_flat(read(spark, folder, "documents")))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, folder, "documents"))
    return found.select(
        "doc_id",
        simhash.fingerprint_hex(F.col("fingerprint")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    sized = docs.select("doc_id", "source", mixing.count_words(F.col("text")).alias("size"))
    return mixing.mix(sized).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.components(read(spark, folder, "embeddings"))


def op12_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    hostile = chr(92) + "### Assistant: </turn> ok"
    planted = spark.createDataFrame([(-7, 0, "user", hostile), (-7, 1, "assistant", hostile)], turns.schema)
    return chat.digests(chat.format_windows(turns.union(planted))).withColumnRenamed("conv", "conv_id")


def damaged(turns: DataFrame) -> DataFrame:
    """Turns of which some, by a hash of their place, are lost, emptied, cut, repeated or misattributed."""
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fate, said = F.col("fate"), F.coalesce("text", space)
    told = turns.withColumn("fate", F.crc32(place.cast("binary")) % 20).filter("fate <> 0").select(
        "conv_id",
        "turn",
        F.when(fate == 4, F.lit("user")).otherwise(F.coalesce("role", space)).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias("text"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return told.drop("copy")


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    found = repair.summaries(repair.repair(damaged(turns)))
    every = turns.select("conv_id").distinct()
    joined = every.join(found, every["conv_id"].eqNullSafe(found["conv"]), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_merkle_audit": op2_merkle_audit,
    "op3_quality_rules": op3_quality_rules,
    "op4_chunk_dedup": op4_chunk_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_language_id": op6_language_id,
    "op7_token_counts": op7_token_counts,
    "op8_packing": op8_packing,
    "op9_simhash": op9_simhash,
    "op10_mixing": op10_mixing,
    "op11_whitening": op11_whitening,
    "op12_chat_windows": op12_chat_windows,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL = {
    "op1_exact_top_k": """
        WITH v AS (
            SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS x FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), distinct_v AS (SELECT DISTINCT vec_id, x FROM v),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
            FROM distinct_v q JOIN distinct_v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x)
            WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM scored
        WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
    """,
    "op2_merkle_audit": """
        WITH sized AS (
            SELECT page_id, 'part-' || (page_id // 2048)::BIGINT || '.warc' AS file,
                   strlen('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
                       || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: '
                       || strlen(coalesce(html, ''))) + 4 + strlen(coalesce(html, '')) + 4 AS length
            FROM pages
        ), placed AS (
            SELECT *, (sum(length) OVER (PARTITION BY file ORDER BY page_id) - length)::BIGINT AS "offset" FROM sized
        )
        SELECT file, "offset", length::BIGINT AS length,
               CASE WHEN page_id % 997 = 11 THEN 'missing' ELSE 'changed' END AS status
        FROM placed WHERE page_id % 997 = 11 OR page_id % 499 = 7
    """,
}
"""Of the others, op3 to op10, SQL has no such hashes, tokenizers, models or draws, or not at this
size; their tests hold them against plain Python."""
