import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparkfolio.operators import backtest as bt
from sparkfolio.operators import metrics as mt
from sparkfolio.plans import fixtures as fx


def test_backtest_invariants(spark, sf_small):
    b = bt.backtest(fx.pred(spark, sf_small)).cache()
    assert b.filter((F.col("drawdown") > 0) | (F.col("drawdown") <= -1)).count() == 0
    assert b.groupBy("trade_date").agg(F.sum("strategy_signal_rank").alias("n")) \
            .filter(F.col("n") > bt.TOP_N).count() == 0
    assert b.groupBy("trade_date", "prediction_rank").count().filter(F.col("count") > 1).count() == 0
    b.unpersist()


def test_chunked_cumulative_equals_plain(spark, sf_small):
    cols = ["cum_strategy_return", "cum_market_return", "drawdown", "drawdown_rank"]
    plain = bt.backtest(fx.pred(spark, sf_small)).select("symbol", "trade_date", *cols)
    chunked = bt.backtest(fx.pred(spark, sf_small), chunk_rows=7).select("symbol", "trade_date", *cols)
    a = {(r.symbol, r.trade_date): r for r in plain.collect()}
    b = {(r.symbol, r.trade_date): r for r in chunked.collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in cols:
            assert a[k][c] == pytest.approx(b[k][c], abs=1e-9)


def test_metrics_hand_rows(spark):
    d = dt.date(2024, 1, 1)
    rows = [("A", d + dt.timedelta(days=i), 1.0, p, y) for i, (p, y) in enumerate(
        [(0.01, 0.02), (-0.01, -0.03), (0.02, -0.01), (0.03, 0.04)])]
    df = spark.createDataFrame(
        rows, "symbol string, trade_date date, close double, prediction double, target_return_next_day double")
    m = mt.backtest_metrics(bt.backtest(df), keep_counts=True).first()
    assert m.num_trading_days == 4 and m.num_days_invested == 3 and m.num_days_invested_rank == 4
    assert m.true_positives == 2 and m.total_positive_predictions == 3
    assert m.model_precision_pct == pytest.approx(200 / 3)
    assert m.total_market_return == pytest.approx(0.02)               # max of running sum, not last
    assert m.alpha == pytest.approx(m.total_strategy_return - m.total_market_return)


def test_sharpe_zero_stddev(spark):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([("A", d, 1.0, -1.0, 0.01), ("A", d + dt.timedelta(days=1), 1.0, -1.0, 0.02)],
                               "symbol string, trade_date date, close double, prediction double, "
                               "target_return_next_day double")
    m = mt.backtest_metrics(bt.backtest(df)).first()
    assert m.sharpe_ratio == 0.0 and m.model_precision_pct == 0.0


def test_split_paths_keep_rows_with_nulls(spark):
    from sparkfolio.operators import series
    rows = [(s, None if i == 0 else f"2024-01-{i + 1:02d}", None if i % 7 == 3 else i / 10, None if i % 5 == 0 else i / 100)
            for s in ("A", "B", None) for i in range(20)]
    df = spark.createDataFrame(rows, "symbol string, d string, prediction double, x double").withColumn("trade_date", F.to_date("d"))
    plain, split = bt.daily_rank(df), bt.daily_rank(df, split_buckets=4)
    key = ["symbol", "trade_date", "prediction_rank"]
    assert sorted(map(str, plain.select(key).collect())) == sorted(map(str, split.select(key).collect()))
    w = Window.partitionBy("symbol").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("run", F.round(F.sum("x").over(w), 9)).select("symbol", "trade_date", "run")
    got = series.prefix_scan(df, {"run": "x"}, chunk_rows=3).withColumn("run", F.round("run", 9))
    assert sorted(map(str, want.collect())) == sorted(map(str, got.select(want.columns).collect()))


@pytest.mark.parametrize("order", ["trade_date", "at"])
def test_prefix_scan_composes_sums_and_maxima(spark, order):
    """Against plain windows: gaps, chunks without values, negative stretches, a series shorter than a chunk."""
    from sparkfolio.operators import series
    rows = [(s, i, None if i % 4 == 0 or 30 <= i < 45 else ((i * 37) % 19 - 11) / 8) for s, n in (("A", 60), ("B", 2), (None, 25)) for i in range(n) if i % 7]
    df = spark.createDataFrame(rows, "symbol string, i int, x double").withColumn("trade_date", F.date_add(F.lit("2024-01-01"), F.col("i"))) \
        .withColumn("at", F.col("trade_date").cast("timestamp")).withColumn("y", -F.col("x"))
    w = Window.partitionBy("symbol").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumns({"sx": F.sum("x").over(w), "sy": F.sum("y").over(w)}).withColumn("m", F.max("sx").over(w))
    got = series.prefix_scan(df, {"sx": "x", "sy": "y"}, {"m": "sx"}, order=order, chunk_rows=5)
    assert got.columns == [*df.columns, "sx", "sy", "m"]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
