"""One query per numbered operator: the operator over its whole table, with the digest columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunk_bpe, conversation_repair, credentials, decontamination, jaccard_join, kneser_ney, language_crf, packing, quality_rules, sharding, spelling, token_counts, toxicity
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.apply(quality_rules.ledger(quality_rules.measure(table(spark, sf_dir, "documents"))))
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~F.col("keep_base")).alias("base_failed"), F.col("keep_v2").alias("kept"), "fail_bits", "keep_v1",
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit", "n_whole")


def op3_credentials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(credentials.find(table(spark, sf_dir, "documents")))


def op4_latent_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.digests(chunk_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))


def op6_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op10_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_crf.is_held_out(F.col("doc_id"))
    crf = language_crf.fit(docs.where(F.col("doc_id").isNotNull() & ~held_out))
    return language_crf.label(docs, crf).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "n_words", "n_other")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.digests(*conversation_repair.repair(conversation_repair.damage(conversations), conversations))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_token_counts, op3_credentials, op4_latent_retrieval, op5_byte_bpe, op6_label_propagation, op7_toxicity, op8_kneser_ney, op9_jaccard_join, op10_language_crf, op11_spelling_variants, op12_best_fit_packing, op13_conversation_repair)}

# DuckDB SQL for the rows of a query.
ORACLE = {
    "op1_quality_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        g AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
        c AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g),
        p AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM c WHERE n > 1) GROUP BY r),
        l AS (SELECT r, count(*) AS n, count(*) - count(DISTINCT x) AS dup
              FROM (SELECT r, unnest(string_split(t, chr(10))) AS x FROM d) WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY r),
        m AS (SELECT doc_id, len(w) AS n_words, length(t) - length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')) AS word_chars,
                     length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_lines,
                     coalesce(l.dup, 0) AS n_dup_lines, coalesce(p.n, 0) AS n_repeat_words
              FROM d LEFT JOIN l USING (r) LEFT JOIN p USING (r)),
        f AS (SELECT *, (n_words < 50)::INT AS f0, (100 * n_repeat_words > 50 * n_words)::INT AS f1, (100 * n_symbols > 10 * word_chars)::INT AS f2,
                     (100 * n_dup_lines > 30 * n_lines)::INT AS f3, (word_chars < 2 * n_words)::INT AS f4, (word_chars > 20 * n_words)::INT AS f5 FROM m)
        SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
               n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, f0 + f1 > 0 AS base_failed,
               f0 + f1 + f2 + f3 + f4 + f5 = 0 AS kept, (f0 + 2 * f1 + 4 * f2 + 8 * f3 + 16 * f4 + 32 * f5)::BIGINT AS fail_bits, f0 + f1 + f2 = 0 AS keep_v1
        FROM f
    """,
}
