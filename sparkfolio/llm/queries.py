"""One registered query for each operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfolio.llm import byte_bpe, pii, token_files
from sparkfolio.llm.block_lstm import main_text
from sparkfolio.llm.fm_dedup import remove_repeats
from sparkfolio.llm.importance import resample
from sparkfolio.llm.mixing import mix_sources
from sparkfolio.llm.ngram_jaccard import ngram_jaccard
from sparkfolio.llm.pu_quality import quality
from sparkfolio.llm.rules import quality_rules
from sparkfolio.llm.toxicity import toxicity
from sparkfolio.llm.vptree import nearest
from sparkfolio.llm.whitening import whiten
from sparkfolio.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard(_table(spark, sf_dir, "documents"))


def op2_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.filter("vec_id % 100 = 0"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.round_trip(_table(spark, sf_dir, "documents"), *model)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def _held_out(folds: int, fold: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), _held_out(3, 1))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op6_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), _held_out(5, 0))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    token_files.write(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.digest(token_files.read(spark, folder))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *(count(k) for k in pii.BASE_KINDS), F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(_table(spark, sf_dir, "embeddings"))
    return white.select("vec_id", "n", "deviation", "identity_error", "deviation_exact", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")) \
        .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
                F.col("c.explained").alias("explained"), "identity_error", "deviation_exact")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_ngram_jaccard, op2_vantage_points, op3_mix_sources, op4_byte_bpe, op5_toxicity, op6_pu_quality, op7_token_files, op8_pii, op9_quality_rules, op10_substring_dedup,
    op11_block_labeller, op12_importance_resampling, op13_whitening)}

ORACLE: dict[str, str] = {}
