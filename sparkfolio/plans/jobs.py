"""End-to-end jobs: landing -> silver -> gold -> model/backtest.

These are the runnable units a user schedules per run day. Each reads
tables, runs the operators and writes tables; the only actions are the
writes, a few bounded guards (``isEmpty``) and the summary counts, which
read a persisted result instead of re-running its lineage.

    python -m sparkfolio.plans.jobs landing --payloads F --bronze B
    python -m sparkfolio.plans.jobs silver --bronze B --prices P --fundamentals-table T \
        --fundamentals-root R --run-date 2024-06-01
    python -m sparkfolio.plans.jobs gold --prices P --fundamentals-table T --gold G
    python -m sparkfolio.plans.jobs ml --gold G --out O --split-date 2024-06-01
    python -m sparkfolio.plans.jobs serving --out O --database D
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.operators import backtest as bt
from sparkfolio.operators import features as ft
from sparkfolio.operators import metrics as mt
from sparkfolio.operators import model as md
from sparkfolio.operators import quality as qa
from sparkfolio.operators import scd2
from sparkfolio.operators import scoring as sc
from sparkfolio.schemas import (
    FEATURES, RAW_PRICES, RAW_RATIOS, SERVING_BACKTEST, SERVING_FUTURE, SERVING_METRICS, SILVER_PRICES)
from sparkfolio.session import checkpoint, scratch_scope
from sparkfolio.sources import history as hs
from sparkfolio.sources import landing as ld
from sparkfolio.sources import readers as rd
from sparkfolio.sources import writers as wr


def _one_dt(run_date: str | None, dt: str | None) -> str | None:
    """Run date to read: ``dt`` if given (``"*"`` = every run), else the run date."""
    value = dt or run_date
    return None if value == "*" else value


def landing_job(spark: SparkSession, payloads: DataFrame, bronze_root: str) -> dict:
    """Fetched payloads (source, dt, symbol, body) -> landing folder; keys that
    are landed already are skipped, errors and empty answers dropped."""
    _, report = ld.land(spark, payloads, bronze_root)
    return {"status": "ok", "sources": report}


def _documents(spark: SparkSession, bronze_root: str, source: str, schema: T.StructType, dt: str | None) -> tuple[DataFrame | None, Observation]:
    """Landed documents of one source, and what is counted of them while they are read."""
    seen = Observation()
    docs = ld.read_documents(spark, bronze_root, source, schema, dt)
    if docs is not None:
        docs = docs.observe(seen, F.count(F.lit(1)).alias("documents"), F.count(rd.CORRUPT).alias("broken"),
                            F.count(rd.RESCUED).alias("undeclared"))
    return docs, seen


def _set_aside(spark: SparkSession, bronze_root: str, source: str, schema: T.StructType, dt: str | None, seen: dict, path: str | None) -> dict:
    """Broken documents and undeclared fields to a quarantine table, if there are any and a place for them."""
    if path and (seen["broken"] or seen["undeclared"]):
        rows = rd.quarantine(ld.read_documents(spark, bronze_root, source, schema, dt)).withColumn("source", F.lit(source))
        wr.write_partitions(rows, path, ["source", "dt"])
    return {"broken": seen["broken"], "undeclared": seen["undeclared"]}


def silver_prices_job(spark: SparkSession, bronze_root: str, prices_path: str,
                      run_date: str, dt: str | None = None, sample_rows: int = 10, quarantine_path: str | None = None) -> dict:
    """Landed price documents of one run (``dt``) -> validated silver prices,
    written with dynamic partition overwrite by ``trade_date``.

    The input is read once: documents, valid and invalid rows are counted, and the invalid sample is taken, while the
    valid rows are written. Only documents that are broken or hold undeclared fields cause a second read, for the quarantine.
    (A stage that runs again after a lost executor may count its rows twice; the table has each row once.)
    """
    one = _one_dt(run_date, dt)
    raw, documents = _documents(spark, bronze_root, "prices", RAW_PRICES, one)
    if raw is None:
        return {"status": "no input"}
    rows = Observation()
    flat = qa.with_lineage(qa.flatten_prices(raw), "twelvedata", run_date)
    valid, _ = qa.split_valid(qa.add_validity(flat).observe(rows, *qa.validity_metrics(sample_rows)))
    wr.write_partitions(valid, prices_path, ["trade_date"])
    seen, found = documents.get, rows.get
    if not seen["documents"]:
        return {"status": "no input"}
    sample = [r.asDict() for i in range(sample_rows) if (r := found[f"sample_{i}"]) is not None]
    return {"status": "ok" if found["valid"] else "no valid rows", "valid": found["valid"], "invalid": found["invalid"],
            "invalid_sample": sample, **_set_aside(spark, bronze_root, "prices", RAW_PRICES, one, seen, quarantine_path)}


def silver_fundamentals_job(spark: SparkSession, bronze_root: str, table: str, table_root: str,
                            run_date: str, dt: str | None = None, null_safe: bool = True,
                            reappend_unchanged: bool = False, keep_versions: int | None = None,
                            quarantine_path: str | None = None) -> dict:
    """Landed ratio payloads of one run -> SCD2 history under ``table_root``: only the years that change are rewritten,
    ``table`` is a view of the last version. ``keep_versions`` drops older ones."""
    one = _one_dt(run_date, dt)
    raw, documents = _documents(spark, bronze_root, "ratios", RAW_RATIOS, one)
    if raw is None:
        return {"status": "no input"}
    with scratch_scope(spark):
        new = checkpoint(scd2.standardize_fundamentals(raw, run_date))   # read for the years, the changes and the merge
        if rd.is_empty(new):
            return {"status": "no input"}
        if not hs.versions(spark, table_root) and spark.catalog.tableExists(table):
            hs.start(spark, table_root, spark.table(table))
        done = hs.merge(spark, table_root, new, run_date, null_safe, reappend_unchanged)
    hs.publish_view(spark, table_root, table)
    if keep_versions:
        hs.vacuum(spark, table_root, keep_versions)
    parts = hs.parts(spark, table_root)
    current, expired = (sum(p.n_rows for p in parts if p.is_current == c) for c in (True, False))
    return {"status": "ok", "total": current + expired, "current": current, "expired": expired, **done,
            **_set_aside(spark, bronze_root, "ratios", RAW_RATIOS, one, documents.get, quarantine_path)}


def gold_job(spark: SparkSession, prices_path: str, fundamentals: DataFrame | str, gold_path: str,
             chunk_rows: int | None = None) -> dict:
    """Silver prices + current fundamentals -> feature table partitioned by symbol.

    ``chunk_rows`` evaluates the windows over chunks of that many rows; the
    rows are the same. The audit counts what the last step drops. An empty
    result leaves the stored table as it is.
    """
    if not rd.table_exists(spark, prices_path) or isinstance(fundamentals, str) and not spark.catalog.tableExists(fundamentals):
        return {"status": "no input"}
    prices = rd.read_table(spark, prices_path, SILVER_PRICES)
    audit = qa.null_report(prices, ["trade_date", "close"]).first()
    fund = spark.table(fundamentals) if isinstance(fundamentals, str) else fundamentals
    gold = ft.gold_features(prices, fund, chunk_rows=chunk_rows)
    if rd.is_empty(gold):
        return {"status": "no rows", **audit.asDict()}
    wr.write_partitions(gold, gold_path, ["symbol"])
    return {"status": "ok", **audit.asDict()}


def ml_job(spark: SparkSession, gold_path: str, out_root: str, split_date: str,
           grid: Mapping[str, Sequence[int]] = md.DEFAULT_GRID, folds: int = md.DEFAULT_FOLDS,
           parallelism: int = 1, top_n: int = bt.TOP_N, chunk_rows: int | None = None,
           rank_buckets: int | None = None, validation: str = "random", gap: int = md.LABEL_GAP,
           fold_col: str | None = None) -> dict:
    """Train + cross-validate, backtest the test period, score the latest day.

    Writes ``backtest_results`` (by symbol), ``backtest_metrics``, its two views ``summary_signal`` and
    ``summary_ranking``, ``cv_report`` and ``future_predictions`` under ``out_root``. ``validation``: "random" folds of
    rows (or those in ``fold_col``), or "walk_forward" blocks of dates with a ``gap``.
    """
    if validation not in ("random", "walk_forward"):
        raise ValueError("validation: random or walk_forward")
    out = out_root.rstrip("/")
    if not rd.table_exists(spark, gold_path):
        return {"status": "no input"}
    gold = rd.read_table(spark, gold_path, text=("symbol",))
    train, test = md.time_split(md.train_ready(gold), split_date)
    before = F.col("trade_date") < F.lit(split_date).cast("date")
    n = md.train_ready(gold).agg(F.count_if(before).alias("train"), F.count_if(~before).alias("test")).first()
    counts = {"train_rows": n.train, "test_rows": n.test}
    if not n.train or not n.test:
        return {"status": "empty train or test set", **counts}
    with scratch_scope(spark):
        if validation == "random":
            model = md.tune(train, grid, folds, parallelism=parallelism, fold_col=fold_col)
        else:
            model = md.tune_walk_forward(train, grid, folds, gap, parallelism=parallelism)
        backtest = bt.backtest(md.score(model, test), top_n=top_n, extra_columns=FEATURES,
                               chunk_rows=chunk_rows, rank_buckets=rank_buckets)
        wr.write_partitions(backtest, f"{out}/backtest_results", ["symbol"])
    wr.replace_table(md.cv_report(spark, model).coalesce(1), f"{out}/cv_report")
    # metrics read the written table instead of re-running scoring + windows; the
    # symbols of this run were overwritten, others keep rows of earlier runs
    written = rd.read_table(spark, f"{out}/backtest_results", text=("symbol",))
    metrics = mt.backtest_metrics(written.join(test.select("symbol").distinct(), "symbol", "left_semi"))
    wr.replace_table(metrics, f"{out}/backtest_metrics")
    metrics = rd.read_table(spark, f"{out}/backtest_metrics")
    wr.replace_table(mt.summary_signal(metrics), f"{out}/summary_signal")
    wr.replace_table(mt.summary_ranking(metrics), f"{out}/summary_ranking")
    latest = sc.latest_rows(gold, date=rd.stored_max(spark, gold_path, "trade_date"))
    result = {"status": "ok", "best_cv_rmse": float(min(model.avgMetrics)), **counts}
    if rd.is_empty(latest):
        return {**result, "top_buys": []}                 # yesterday's predictions stay
    future = sc.recommendation(md.score(model, latest))
    wr.replace_table(future, f"{out}/future_predictions")
    top = sc.top_buys(rd.read_table(spark, f"{out}/future_predictions")).collect()
    return {**result, "top_buys": [r.asDict() for r in top]}


def serving_job(spark: SparkSession, out_root: str, database: str = "default") -> dict:
    """Register what ``ml_job`` wrote as tables with declared columns; what is not written yet is left out."""
    served = {"backtest_results": SERVING_BACKTEST, "backtest_metrics": SERVING_METRICS, "future_predictions": SERVING_FUTURE}
    done = []
    for name, schema in served.items():
        path = f"{out_root.rstrip('/')}/{name}"
        if rd.table_exists(spark, path):
            wr.register_external(spark, f"{database}.{name}", path, schema)
            done.append(name)
    return {"status": "ok" if done else "no input", "tables": done}


def main(argv: Sequence[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="sparkfolio.plans.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    n = sub.add_parser("landing")
    n.add_argument("--payloads", required=True)
    n.add_argument("--bronze", required=True)
    v = sub.add_parser("serving")
    v.add_argument("--out", required=True)
    v.add_argument("--database", default="default")
    s = sub.add_parser("silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--prices", required=True)
    s.add_argument("--fundamentals-table", required=True)
    s.add_argument("--fundamentals-root", required=True)
    s.add_argument("--run-date", required=True)
    s.add_argument("--dt", help="run date of the landed documents; * for all")
    s.add_argument("--keep-versions", type=int)
    s.add_argument("--quarantine", help="table for broken documents and undeclared fields")
    g = sub.add_parser("gold")
    g.add_argument("--prices", required=True)
    g.add_argument("--fundamentals-table", required=True)
    g.add_argument("--gold", required=True)
    g.add_argument("--chunk-rows", type=int)
    m = sub.add_parser("ml")
    m.add_argument("--gold", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--split-date", required=True)
    m.add_argument("--parallelism", type=int, default=1)
    m.add_argument("--max-depth", type=int, nargs="+", default=list(md.DEFAULT_GRID["maxDepth"]))
    m.add_argument("--max-iter", type=int, nargs="+", default=list(md.DEFAULT_GRID["maxIter"]))
    m.add_argument("--folds", type=int, default=md.DEFAULT_FOLDS)
    m.add_argument("--fold-col")
    m.add_argument("--validation", choices=("random", "walk_forward"), default="random")
    m.add_argument("--gap", type=int, default=md.LABEL_GAP)
    m.add_argument("--top-n", type=int, default=bt.TOP_N)
    m.add_argument("--chunk-rows", type=int)
    m.add_argument("--rank-buckets", type=int)
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"sparkfolio-{a.job}").getOrCreate()
    if a.job == "landing":
        print(landing_job(spark, rd.read_table(spark, a.payloads), a.bronze))
    elif a.job == "serving":
        print(serving_job(spark, a.out, a.database))
    elif a.job == "silver":
        print(silver_prices_job(spark, a.bronze, a.prices, a.run_date, a.dt, quarantine_path=a.quarantine))
        print(silver_fundamentals_job(spark, a.bronze, a.fundamentals_table, a.fundamentals_root, a.run_date, a.dt,
                                      keep_versions=a.keep_versions, quarantine_path=a.quarantine))
    elif a.job == "gold":
        print(gold_job(spark, a.prices, a.fundamentals_table, a.gold, a.chunk_rows))
    else:
        print(ml_job(spark, a.gold, a.out, a.split_date, {"maxDepth": a.max_depth, "maxIter": a.max_iter}, a.folds, a.parallelism, a.top_n,
                     a.chunk_rows, a.rank_buckets, a.validation, a.gap, a.fold_col))


if __name__ == "__main__":
    main()
