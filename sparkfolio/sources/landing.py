"""Landing zone for raw API payloads (K7-K9), with a key ledger.

The reference fetches one payload per (source, run day, symbol) in a serial
loop, skips keys already landed and drops error / empty answers. Here the
payloads are a DataFrame ``(source, dt, symbol, body)`` and the same rules
are set operations over two Parquet folders:

``payloads/dt=/source=/run=``  symbol, body as it came, content_hash
``ledger/dt=``                 source, symbol, content_hash, run: one small row a landed key

A run reads the ledger of its own run dates only (folders asked for by name,
history is neither listed nor read), writes its new payloads, then appends
their keys to the ledger. The ledger is the commit: payloads of a run that died
before it are not seen by :func:`read_landed`, and the next run lands their keys again.

* :func:`classify_payloads` - ``outcome`` = ``error`` (prices: ``"status": "error"``;
  ratios: an ``"Error Message"`` key; no JSON object or array at all; no key), ``empty``
  (blank, ``[]`` or ``{}``) or ``ok``, and the ``reason``
* :func:`land_new` - one payload a key (of several the smallest by text) that the ledger does not hold
* :func:`landing_summary` - fetched / skipped / failed counts per source
* :func:`read_documents` - landed bodies of one source parsed to a declared schema, with drift capture
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.operators.asof import first_per_group
from sparkfolio.sources.paths import partition_folder, path_exists
from sparkfolio.sources.readers import parse_documents

KEYS = ("source", "dt", "symbol")
PAYLOADS = "symbol string, body string, content_hash string, dt string, source string, run string"
LEDGER = "source string, symbol string, content_hash string, run string, dt string"
MAX_PRUNED_DTS = 1000
SOURCES = ("prices", "ratios")
STATUSES = ("fetched", "skipped", "failed")


def reason_expr(body: str = "body", source: str = "source") -> Column:
    """Why a payload is not landed, null for one that is. JSON is read as leniently as clients read
    it: repeated keys and NaN are fine, text after the document is not."""
    b = F.col(body)
    trimmed = F.trim(F.regexp_replace(b, r"\s+$", ""))
    fields = F.from_json(b, "map<string,string>")
    is_json = F.when(trimmed.startswith("{"), fields.isNotNull() & trimmed.endswith("}")) \
        .when(trimmed.startswith("["), F.from_json(b, "array<string>").isNotNull() & trimmed.endswith("]")) \
        .otherwise(F.lit(False))
    return F.when(b.isNull() | trimmed.isin("", "[]", "{}"), F.lit("blank")) \
        .when(~F.coalesce(is_json, F.lit(False)), F.lit("no JSON")) \
        .when((F.col(source) == "prices") & (F.element_at(fields, "status") == "error"), F.lit("status error")) \
        .when((F.col(source) == "ratios") & F.map_contains_key(fields, "Error Message"), F.lit("error message")) \
        .when(reduce(and_, [F.col(k).isNotNull() for k in KEYS]), F.lit(None).cast("string")).otherwise(F.lit("no key"))


def classify_payloads(df: DataFrame, body: str = "body") -> DataFrame:
    return df.withColumn("reason", reason_expr(body)).withColumn(
        "outcome", F.when(F.col("reason").isNull(), F.lit("ok")).when(F.col("reason") == "blank", F.lit("empty")).otherwise(F.lit("error")))


def split_payloads(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(good payloads, failed payloads with their outcome and reason)."""
    c = classify_payloads(df, body)
    return c.filter(F.col("outcome") == "ok").drop("outcome", "reason"), c.filter(F.col("outcome") != "ok")


def batch_dts(incoming: DataFrame, limit: int = MAX_PRUNED_DTS) -> list[str] | None:
    """The run dates (``dt``) of a batch, or None when there are more than
    ``limit`` (then no pruning). Bounded: at most ``limit + 1`` values."""
    dts = [r.dt for r in incoming.select("dt").filter(F.col("dt").isNotNull()).distinct().limit(limit + 1).collect()]
    return None if len(dts) > limit else dts


def _read(spark: SparkSession, root: str, part: str, schema: str, dts: Sequence[str] | None, below: str = "") -> DataFrame | None:
    """One of the two folders, or only the folders of some run dates in it; None where there is none."""
    base = f"{root.rstrip('/')}/{part}"
    paths = [base] if dts is None else [f"{base}/{partition_folder(spark, 'dt', d)}" for d in dts]
    paths = [p + below for p in paths if path_exists(spark, p)]
    return spark.read.schema(schema).option("basePath", base).parquet(*paths) if paths else None


def ledger(spark: SparkSession, root: str, dts: Sequence[str] | None = None) -> DataFrame | None:
    """Ledger rows; with ``dts`` only the folders of those run dates are opened."""
    return _read(spark, root, "ledger", LEDGER, dts)


def landed_keys(spark: SparkSession, root: str, keys: Sequence[str] = KEYS,
                dts: Sequence[str] | None = None) -> DataFrame | None:
    """Keys that are landed, of all run dates or of ``dts``."""
    rows = ledger(spark, root, dts)
    return None if rows is None else rows.select(*keys).distinct()


def read_landed(spark: SparkSession, root: str, dts: Sequence[str] | None = None) -> DataFrame | None:
    """Landed payloads (value, source, dt, symbol), bodies as they came; None where nothing is landed."""
    done, bodies = ledger(spark, root, dts), _read(spark, root, "payloads", PAYLOADS, dts)
    if done is None or bodies is None:
        return None
    return bodies.join(done.select("run").distinct(), "run", "left_semi").select(F.col("body").alias("value"), *KEYS)


def read_documents(spark: SparkSession, root: str, source: str, schema: T.StructType, dt: str | None = None) -> DataFrame | None:
    """Documents of one source and run date (None: all) in the columns of ``schema``, with dt, symbol key, the
    broken text and the fields that the schema does not know (:func:`~sparkfolio.sources.readers.parse_documents`)."""
    landed = read_landed(spark, root, None if dt is None else [dt])
    if landed is None:
        return None
    return parse_documents(landed.filter(F.col("source") == source), schema, "value", {"dt": "dt", "key_symbol": "symbol"})


def _status() -> Column:
    return F.when(F.col("_landed"), F.lit("skipped")) \
        .when(F.col("outcome") != "ok", F.lit("failed")).otherwise(F.lit("fetched"))


def _judged(incoming: DataFrame, landed: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Payloads with their outcome and status: skipped, failed or fetched."""
    c = classify_payloads(incoming)
    known = F.lit(None).cast("boolean")
    c = c.withColumn("_landed", known) if landed is None else c.join(landed.withColumn("_landed", F.lit(True)), list(keys), "left")
    return c.withColumn("status", _status()).drop("_landed")


def land(spark: SparkSession, incoming: DataFrame, root: str, keys: Sequence[str] = KEYS,
         sources: Sequence[str] = SOURCES) -> tuple[DataFrame, dict[str, int]]:
    """Write the new good payloads, then their keys to the ledger. Returns the keys landed by this run, and the payloads of
    each source and status ("prices/fetched"), counted while they are written. A run without new payloads writes no file."""
    root, run, dts = root.rstrip("/"), uuid.uuid4().hex, batch_dts(incoming)
    judged, counts = _judged(incoming, landed_keys(spark, root, keys, dts), keys), Observation()
    judged = judged.observe(counts, *[F.count_if((F.col("source") == s) & (F.col("status") == o)).alias(f"{s}/{o}") for s in sources for o in STATUSES])
    fresh = first_per_group(judged.filter(F.col("status") == "fetched").select(*keys, "body"), list(keys), [F.col("body").asc()])
    seen = Observation()
    written = [F.count(F.lit(1)).alias("n")] + ([] if dts is None else [F.collect_set("dt").alias("dts")])   # MAX_PRUNED_DTS at most
    (fresh.select("symbol", "body", F.sha2("body", 256).alias("content_hash"), "dt", "source", F.lit(run).alias("run"))
          .hint("rebalance", "dt", "source").observe(seen, *written)
          .write.mode("append").partitionBy("dt", "source", "run")
          .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/payloads"))
    report = {k: n for k, n in counts.get.items() if n}
    if not seen.get["n"]:
        return spark.createDataFrame([], ", ".join(f"{k} string" for k in keys)), report
    mine = _read(spark, root, "payloads", PAYLOADS, None if dts is None else sorted(seen.get["dts"]), "" if dts is None else f"/source=*/run={run}")
    mine = mine.filter(F.col("run") == run).select("source", "symbol", "content_hash", "run", "dt")
    (mine.hint("rebalance", "dt").write.mode("append").partitionBy("dt")
         .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/ledger"))
    return mine.select(*keys), report


def land_new(spark: SparkSession, incoming: DataFrame, root: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """The keys that :func:`land` landed."""
    return land(spark, incoming, root, keys)[0]


def landing_summary(incoming: DataFrame, landed: DataFrame | None, keys: Sequence[str] = KEYS) -> DataFrame:
    """(source, outcome, n): skipped = key already landed; failed = error or
    empty payload; fetched = landed by this run."""
    return _judged(incoming, landed, keys).groupBy("source", F.col("status").alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
