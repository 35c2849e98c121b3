"""From raw documents to training rows, in five stages; each stage's rows are written and read again by the next.

1. language: documents without a letter, or whose words no language explains, go.
2. near duplicates: of each group of linked documents the one with the smallest id stays.
3. decontamination: documents that hold a passage of a benchmark item go.
4. secrets: found credentials are replaced in the text; the document stays.
5. encoding: token ids of each text, with digests of the ids and of the decoded bytes.

Stages 1 to 4 return the columns of ``documents``.  ``run`` writes between the stages into the shared folder.

Defined results: documents with a null or empty text go in stage 1; repeated rows of a document and its text stay once (stage 2), and of
equal or linked documents the smallest id stays, a null id only where there is no other; further columns are carried as they are, whatever
their names, and ``n_chars`` follows the text where there is one; an empty table gives an empty result in every stage; a very long text is
judged, searched, masked and encoded whole.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypanel.llm import chunk_bpe, credentials, decontamination, jaccard_join, language_crf
from daypanel.llm.common import stored, table

LEAST_SCORE = 0.5  # share of a document's words in its language


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held_out = language_crf.is_held_out(F.col("doc_id"))
    crf = language_crf.fit(docs.where(F.col("doc_id").isNotNull() & ~held_out))
    return language_crf.accepted(docs, crf, LEAST_SCORE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.first_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = credentials.redact(docs, credentials.find(docs))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return chunk_bpe.digests(chunk_bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("encoding", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# SQL can express neither the trained models nor the tokenizer; tests hold the rows against plain versions.
ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
