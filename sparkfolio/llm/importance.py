"""Importance resampling towards a target text collection, on hashed n-grams.

Words come from a Regex Split pre-tokeniser of the tokenizers library (nothing is trained) over text whose A-Z are
lower-cased; a feature is a window of one to ``MAX_N`` consecutive words, from the start offset of its first word to
the end offset of its last, joined by one space. Its bucket is the CRC of its UTF-8 bytes modulo ``BUCKETS``.

1. every document becomes its sorted buckets, written once (two bytes a feature before compression)
2. buckets are counted over all documents and over all target texts; each task adds up before the shuffle
3. a document's weight is the sum of its buckets' gains; a Gumbel draw from the hash of its id is added
4. the highest scores are drawn: rows are dealt by ranges of (score, id), so no task ranks them all

What reaches the driver: one row for each bucket, and one for each range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Regex, pre_tokenizers

from sparkfolio.llm.spark_env import prepare, stored, trim
from sparkfolio.session import scratch_path

#: The word pattern, the longest window, the number of buckets.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MAX_N = 3
BUCKETS = 10_000
#: Characters tokenised at once; a longer text goes in pieces that end between words, with the last words carried over.
PIECE = 1 << 18
#: Characters of text in one output batch, about.
BATCH_CHARS = 4 << 20

FEATURES = "n_words bigint, n_features bigint, buckets binary"


def _pieces(text: str) -> Iterator[str]:
    """Pieces of the text that end at a space; words longer than a piece stay whole."""
    at = 0
    while len(text) - at > PIECE:
        end = text.find(" ", at + PIECE)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def windows(words: Sequence[bytes], carry: int = 0, n: int = MAX_N) -> Iterator[int]:
    """CRC of each window of 1 to ``n`` words that ends after the first ``carry`` words. A window's CRC goes on from
    that of the window without its last word."""
    spaced = [b" " + w for w in words]
    crcs = list(map(crc32, words))
    yield from islice(crcs, carry, None)
    for size in range(2, n + 1):
        crcs = list(map(crc32, spaced[size - 1:], crcs))
        yield from islice(crcs, max(0, carry - size + 1), None)


def text_buckets(split: pre_tokenizers.PreTokenizer, text: str | None, n_buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """(number of words, sorted buckets) of one whole text."""
    if not text:
        return 0, np.zeros(0, np.int64)
    lower = text.encode().lower().decode()              # bytes.lower() changes A-Z alone
    total, last, parts = 0, [], []
    for piece in _pieces(lower):
        found = [word.encode() for word, _ in split.pre_tokenize_str(piece)]
        total += len(found)
        found = last + found
        parts.append(np.fromiter(windows(found, len(last)), np.int64) % n_buckets)
        last = found[-(MAX_N - 1):]
    return total, np.sort(np.concatenate(parts))


def pack(buckets: np.ndarray) -> bytes:
    """Sorted buckets as differences, low bytes before high bytes, which compress well."""
    return np.diff(buckets, prepend=0).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, np.uint8).reshape(2, -1).T.copy().view("<u2").ravel(), dtype=np.int64)


def _featurise(keep: int, n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        for batch in batches:
            texts, at = batch.column(keep), 0
            while at < len(texts):
                rows, chars, start = [], 0, at
                while at < len(texts) and chars < BATCH_CHARS:
                    text = texts[at].as_py()
                    words, buckets = text_buckets(split, text, n_buckets)
                    rows.append((words, len(buckets), pack(buckets)))
                    chars, at = chars + len(text or ""), at + 1
                words, sizes, raw = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(start, at - start) for i in range(keep)),
                     pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(raw, pa.binary())],
                    names=[*batch.schema.names[:keep], "n_words", "n_features", "buckets"])
        trim()
    return run


def features(docs: DataFrame, ids: Sequence[str] = ("doc_id",), text: str = "text", n_buckets: int = BUCKETS) -> DataFrame:
    """``ids``, n_words, n_features and packed buckets of each row's whole text; null and empty texts have none."""
    prepare(docs.sparkSession)
    cut = docs.select(*[F.col(f"`{c}`").alias(f"id{i}") for i, c in enumerate(ids)], F.col(f"`{text}`").cast("string").alias("text"))
    kept = "".join(f"id{i} {f.dataType.simpleString()}, " for i, f in enumerate(cut.schema.fields[:-1]))
    out = cut.mapInArrow(_featurise(len(ids), n_buckets), kept + FEATURES)
    return out.select(*[F.col(f"id{i}").alias(c) for i, c in enumerate(ids)], "n_words", "n_features", "buckets")


def bucket_counts(packed: DataFrame, n_buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                total += np.bincount(unpack(raw.as_py()), minlength=n_buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])
        trim()

    prepare(packed.sparkSession)
    counts = np.zeros(n_buckets, np.int64)
    for row in packed.select("buckets").mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain: a thousand times the log ratio of smoothed shares, rounded down."""
    n = len(own)
    s_all, t_all = float(own.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all))) for s, t in zip(own, target)], np.int64)


def _weigh(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("buckets")
            weight = [int(gain[unpack(raw.as_py())].sum()) for raw in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(at)), pa.array(weight, pa.int64())],
                                             names=[*batch.schema.names[:at], "weight"])
        trim()
    return run


def gumbel(doc_id: Column, seed: str = "42") -> Column:
    """floor(-1000 ln(-ln u)) with u from the SHA-256 of ``seed:doc_id``; null for a null id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _ranked(scored: DataFrame, draw: int) -> DataFrame:
    """``scored`` with rank 1..``draw`` by falling score, then rising id, over the rows marked ``fit``; null beyond.

    Rows are dealt by ranges of (score, id, row), so equal rows part too, and written with their range's number.
    Ranges that begin within the draw are numbered; the others need no order."""
    spark = scored.sparkSession
    order = [F.col("score").desc(), F.col("doc_id").asc(), F.col("row").asc()]
    dealt = stored(scored.filter("fit").repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "importance-ranges")
    sizes = sorted((r["range"], r["n"]) for r in dealt.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect())
    before, starts = 0, []
    for number, n in sizes:
        if before < draw:
            starts.append((number, before))
        before += n
    first = spark.createDataFrame(starts, "range int, before bigint")
    last = max((number for number, _ in starts), default=-1)
    inside = dealt.filter(F.col("range") <= last).join(F.broadcast(first), "range") \
        .withColumn("rank", F.col("before") + F.row_number().over(Window.partitionBy("range").orderBy(*order)))
    inside = inside.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    columns = [c for c in scored.columns if c not in ("fit", "row")]
    none = F.lit(None).cast("bigint").alias("rank")
    return inside.select(*columns, "rank").unionByName(
        dealt.filter(F.col("range") > last).select(*columns, none)).unionByName(
        scored.filter(~F.col("fit")).select(*columns, none))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: str = "42",
             n_buckets: int = BUCKETS) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null where not drawn), one row for each row of ``docs``.

    ``docs`` needs doc_id and text, ``target`` needs text; other columns, of any name, are not read. Null and empty texts have
    no features and weigh 0. Of the N rows with an id and at least ``min_words`` words the floor(percent N / 100) highest
    scores are drawn, ties to the smaller id; repeated rows tie and take ranks in a row. A row without an id has no hash,
    so no score and no part in the draw. An empty target gives gains towards rarer buckets only; empty ``docs`` give no row.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "importance")
    found = features(docs, n_buckets=n_buckets)
    found.write.option("compression", "zstd").parquet(path)
    packed = spark.read.schema(found.schema).parquet(path)
    gain = gains(bucket_counts(packed, n_buckets), bucket_counts(features(target, (), n_buckets=n_buckets), n_buckets))
    kind = packed.schema["doc_id"].dataType.simpleString()
    weighed = packed.mapInArrow(_weigh(gain), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")
    fit = F.col("doc_id").isNotNull() & (F.col("n_words") >= min_words)
    scored = stored(weighed.select(
        "doc_id", "n_words", "n_features", "weight", (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score"),
        fit.alias("fit"), F.monotonically_increasing_id().alias("row")), "importance-scores")
    drawn = scored.agg(F.count_if("fit")).first()[0] * percent // 100
    return _ranked(scored, drawn)
