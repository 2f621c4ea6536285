"""The three jobs chained on the smallest tables, landing included."""

from sparkfolio.operators import quality as qa
from sparkfolio.plans import fixtures as fx
from sparkfolio.plans import jobs
from sparkfolio.session import scratch_path, unique_name
from sparkfolio.sources import readers as rd


def test_jobs_end_to_end(spark, sf_small):
    bronze = scratch_path(spark, "bronze")
    payloads = fx.payloads(spark, sf_small)
    first = jobs.landing_job(spark, payloads, bronze)["sources"]
    assert first["prices/fetched"] and "prices/skipped" not in first
    again = jobs.landing_job(spark, payloads, bronze)["sources"]
    assert again["prices/skipped"] == first["prices/fetched"] and "prices/fetched" not in again

    prices = scratch_path(spark, "silver_prices")
    res = jobs.silver_prices_job(spark, bronze, prices, "2002-02-01", dt="*")
    counts = qa.validity_counts(qa.flatten_prices(fx.raw_docs(spark, sf_small))).agg(
        {"valid_rows": "sum", "invalid_rows": "sum"}).first()
    assert (res["valid"], res["invalid"]) == (counts["sum(valid_rows)"], counts["sum(invalid_rows)"])
    assert len(res["invalid_sample"]) == 10
    assert rd.read_table(spark, prices).count() == res["valid"]

    table, root = unique_name("fundamentals"), scratch_path(spark, "fund")
    r1 = jobs.silver_fundamentals_job(spark, bronze, table, root, "2002-02-01", dt="*")
    n_reports = fx.fund_incoming(spark, sf_small).count()
    assert (r1["status"], r1["total"], r1["current"], r1["expired"], r1["new"]) == ("ok", n_reports, n_reports, 0, n_reports)
    r2 = jobs.silver_fundamentals_job(spark, bronze, table, root, "2002-03-01", dt="*")
    assert (r2["changed"], r2["new"]) == (0, 0)
    assert r2["total"] == n_reports and r2["expired"] == 0          # unchanged rerun appends nothing

    gold = scratch_path(spark, "gold")
    g = jobs.gold_job(spark, prices, table, gold)
    assert g["nb_null_close"] == 0
    assert rd.read_table(spark, gold).count() == res["valid"]     # valid rows are unique per symbol/day

    out = scratch_path(spark, "ml")
    m = jobs.ml_job(spark, gold, out, fx.SPLIT_DATE, grid={"maxDepth": (2,), "maxIter": (2,)}, folds=2)
    assert m["status"] == "ok" and len(m["top_buys"]) <= 5 and m["train_rows"] and m["test_rows"]
    assert rd.read_table(spark, f"{out}/summary_ranking").count() == rd.read_table(spark, f"{out}/backtest_metrics").count()
    assert rd.read_table(spark, f"{out}/cv_report").count() == 1
    w = jobs.ml_job(spark, gold, out, fx.SPLIT_DATE, grid={"maxDepth": (2,), "maxIter": (2,)}, folds=2, validation="walk_forward",
                    chunk_rows=128, rank_buckets=3)
    assert w["status"] == "ok" and w["train_rows"] == m["train_rows"]
    bt = rd.read_table(spark, f"{out}/backtest_results")
    assert {"prediction", "drawdown", "rsi_14"} <= set(bt.columns)
    assert rd.read_table(spark, f"{out}/backtest_metrics").count() == bt.select("symbol").distinct().count()
    assert jobs.serving_job(spark, out)["tables"] == ["backtest_results", "backtest_metrics", "future_predictions"]
    assert spark.table("future_predictions").columns[-1] == "prediction_pct"


def test_missing_input_is_skipped(spark):
    gone = scratch_path(spark, "missing")
    assert jobs.silver_prices_job(spark, gone, gone, "2024-01-01")["status"] == "no input"
    assert jobs.silver_fundamentals_job(spark, gone, unique_name("t"), gone, "2024-01-01")["status"] == "no input"
    assert jobs.gold_job(spark, gone, unique_name("t"), gone)["status"] == "no input"
    assert jobs.ml_job(spark, gone, gone, fx.SPLIT_DATE)["status"] == "no input"


def test_silver_reads_its_input_once_and_sets_aside(spark, monkeypatch):
    from sparkfolio.sources import landing as ld
    bronze, prices, aside = (scratch_path(spark, n) for n in ("bronze", "prices", "aside"))
    values = '"values": [{"datetime": "2024-01-02", "open": "1", "high": "2", "low": "1", "close": "2", "volume": "5"}'
    bodies = {"0700": f'{{"meta": {{"symbol": "0700"}}, {values}]}}', "0005": f'{{"meta": {{"symbol": "0005", "tz": "x"}}, {values}, {{"datetime": "bad"}}]}}',
              "W": '{"meta": {"symbol": "W"}, "values": "none"}', "N": '{"meta": {"symbol": "N"}, "values": [], "rate": NaN}'}
    ld.land_new(spark, spark.createDataFrame([("prices", "2024-01-03", s, b) for s, b in bodies.items()],
                                             "source string, dt string, symbol string, body string"), bronze)
    reads = []
    monkeypatch.setattr(ld, "read_documents", lambda *a, f=ld.read_documents: reads.append(a) or f(*a))
    res = jobs.silver_prices_job(spark, bronze, prices, "2024-01-03")
    assert len(reads) == 1 and (res["valid"], res["invalid"], res["broken"], res["undeclared"]) == (2, 1, 1, 2)
    assert res["invalid_sample"] == [{"symbol": "0005", "trade_date": None, "open": None, "high": None, "low": None, "close": None, "volume": None}]
    assert {r.symbol for r in rd.read_table(spark, prices).collect()} == {"0700", "0005"}
    assert jobs.silver_prices_job(spark, bronze, prices, "2024-01-04")["status"] == "no input"
    jobs.silver_prices_job(spark, bronze, prices, "2024-01-03", quarantine_path=aside)
    found = sorted((r.key_symbol, r.reason, r.path) for r in spark.read.schema("key_symbol string, reason string, path string").parquet(aside).collect())
    assert found == [("0005", "undeclared", "meta.tz"), ("N", "undeclared", "rate"), ("W", "broken", "")]
    assert not spark.sparkContext._jsc.getPersistentRDDs()
