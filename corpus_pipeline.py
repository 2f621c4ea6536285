"""Corpus pipeline: from raw documents to token ids, in five stages.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows of ``docs`` and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfolio.llm import byte_bpe, mixing, ngram_jaccard, pii, rules
from sparkfolio.llm.spark_env import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the threshold table rejects go."""
    return rules.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that are linked, one row stays: the one with the smallest doc_id, an id before none."""
    return ngram_jaccard.one_of_each(docs, apart=False)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become what the mix takes of them; documents that it does not touch go."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the digest of what the ids decode to."""
    model = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.round_trip(docs, *model)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", near_duplicates),
    ("pii", personal_data),
    ("source mix", source_mix),
    ("byte-level bpe", token_ids),
]

#: SQL has no byte-pair merges; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"stage{at}")
    return docs
