import datetime as dt

import pytest
from pyspark.sql import functions as F

from sparkfolio.operators import features as ft
from sparkfolio.operators import indicators as ind


def _series(spark, closes, symbol="A"):
    start = dt.date(2024, 1, 1)
    rows = [(symbol, start + dt.timedelta(days=i), float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, trade_date date, close double")


def _col(df, name):
    return [r[name] for r in df.orderBy("trade_date").collect()]


def test_rsi_flat_all_gain_one_row(spark):
    assert _col(ind.rsi(_series(spark, [5] * 20)), "rsi_14")[-1] == 0.0        # flat -> 0
    gain = _col(ind.rsi(_series(spark, range(1, 21))), "rsi_14")
    # all gain: avg_loss 0 -> replaced by 1, rs = avg gain (13/14 then 1)
    assert gain[-1] == pytest.approx(100 - 100 / 2)
    assert _col(ind.rsi(_series(spark, [7])), "rsi_14") == [0.0]               # first row: gain = loss = 0


def test_bollinger_and_pct_b_width_zero(spark):
    df = ind.bollinger(_series(spark, [3] * 5)).withColumn("pct_b", ft.pct_b_expr())
    rows = df.orderBy("trade_date").collect()
    assert rows[0].bollinger_upper is None and rows[0].pct_b is None   # 1-row stddev is null
    assert all(r.pct_b == 0.0 for r in rows[1:])                        # width 0 -> 0


def test_macd_equals_sma_diff(spark):
    df = ind.macd(_series(spark, [1, 5, 2, 8, 3, 9, 4]))
    assert all(r.macd_line == r.sma_diff for r in df.collect())


def test_label_and_log_return(spark):
    df = ft.log_return(_series(spark, [10, 11, 0.0])).withColumn("y", ft.next_day_return_expr())
    rows = df.orderBy("trade_date").collect()
    assert rows[0].daily_return is None and rows[1].daily_return == pytest.approx(0.0953101798)
    assert rows[2].daily_return is None                   # ln(0) -> null
    assert rows[0].y == pytest.approx(0.1) and rows[2].y == 0.0    # close 0 -> 0
    last = ft.log_return(_series(spark, [10, 11])).withColumn("y", ft.next_day_return_expr())
    assert _col(last, "y")[-1] is None


def test_no_look_ahead(spark):
    full = _series(spark, [10, 12, 11, 13, 15, 14, 16, 18, 17, 19, 20, 22, 21, 23, 25])
    cut = full.filter(F.col("trade_date") <= dt.date(2024, 1, 10))
    cols = ["rsi_14", "macd_line", "volatility_10d", "return_lag_1"]

    def feats(df):
        return {r.trade_date: tuple(r[c] for c in cols) for r in ft.feature_columns(df).collect()}

    a, b = feats(full), feats(cut)
    assert all(a[d] == b[d] for d in b)


def test_single_window_exchange(spark, sf_small):
    from sparkfolio.plans import fixtures as fx
    plan = ft.feature_columns(fx.bars(spark, sf_small).withColumns(
        {"pe_ratio": F.lit(1.0), "debt_to_equity": F.lit(1.0)}))._jdf.queryExecution().executedPlan().toString()
    # one shuffle for the bars aggregate + one for the whole block of windows
    assert plan.count("Exchange hashpartitioning") == 2


def test_chunked_features_equal_plain(spark, sf_small):
    """Chunks of 40 rows (several per symbol) with 25-row halos give the same values."""
    from sparkfolio.operators.series import chunked_apply
    from sparkfolio.plans import fixtures as fx
    base = fx.bars(spark, sf_small).withColumns({"pe_ratio": F.lit(1.0), "debt_to_equity": F.lit(1.0)})
    cols = ["sma_20", "bollinger_upper", "macd_line", "rsi_14", "daily_return", "return_lag_3",
            "volatility_10d", "pct_b", "target_return_next_day"]
    plain = {(r.symbol, r.trade_date): r for r in ft.feature_columns(base).select("symbol", "trade_date", *cols).collect()}
    chunked = {(r.symbol, r.trade_date): r for r in
               chunked_apply(base, ft.feature_columns, chunk_rows=40).select("symbol", "trade_date", *cols).collect()}
    assert plain.keys() == chunked.keys()
    for k, a in plain.items():
        b = chunked[k]
        for c in cols:
            assert (a[c] is None and b[c] is None) or a[c] == pytest.approx(b[c], rel=1e-9, abs=1e-12), (k, c)
