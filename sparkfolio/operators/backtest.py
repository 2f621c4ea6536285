"""Signal and ranking backtests over scored rows.

Input: one row per (symbol, trade_date) with ``prediction`` and the label
``target_return_next_day``.

* signal strategy: invest when prediction > ``threshold`` (-0.005)
* ranking strategy: invest in the ``top_n`` (6) best predictions of each day;
  ``prediction_rank`` is the daily row number by prediction desc, symbol asc
* returns: strategy = signal x label; market = label
* cumulative returns: running sums per symbol by date; wealth = exp(cum)
  (the label is a simple return, wealth treats it as a log return - kept)
* drawdown = (wealth - running max wealth) / running max wealth

Two partitionings are needed and used once each: the daily cross-section
(partition by date) and the per-symbol series (partition by symbol).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkfolio.functions.columns import null_safe_join

from sparkfolio.schemas import BACKTEST_COLUMNS, LABEL
from sparkfolio.session import stored

THRESHOLD = -0.005
TOP_N = 6


def signal_strategy(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    return df.withColumn(
        "strategy_signal", F.when(F.col("prediction") > threshold, F.lit(1)).otherwise(F.lit(0)))


def daily_rank(df: DataFrame, top_n: int = TOP_N, date: str = "trade_date",
               split_buckets: int | None = None) -> DataFrame:
    """``prediction_rank`` (row number per date by prediction desc, symbol
    asc) and ``strategy_signal_rank`` (1 for the top ``top_n``).

    ``split_buckets`` evaluates the exact same ranks without sending a whole
    date to one task (for dates holding a large share of the rows): per-date
    approximate quantiles (a mergeable sketch, partially aggregated) cut each
    date into ``split_buckets`` value ranges; row counts per (date, range)
    give each range its rank offset; ranks are offset + row number inside the
    range. Equal predictions always fall in the same range, so ranks stay exact.
    The input is written once to the scratch folder, since it is read three times.
    """
    order = [F.col("prediction").desc_nulls_last(), F.col("symbol").asc()]
    if not split_buckets or split_buckets < 2:
        w = Window.partitionBy(date).orderBy(*order)
        ranked = df.withColumn("prediction_rank", F.row_number().over(w))
    else:
        # bounds/offsets have one row per date (per range): joined without a
        # hint, AQE broadcasts them when their measured size is small.
        probs = [i / split_buckets for i in range(1, split_buckets)]
        df = stored(df, "rank-input")              # read for the bounds, the counts and the rows
        bounds = df.groupBy(date).agg(F.percentile_approx("prediction", probs, 10_000).alias("_bounds"))
        x = null_safe_join(df, bounds, [date])
        pred = F.col("prediction")
        x = x.withColumn("_b", F.when(pred.isNull(), F.lit(split_buckets)).otherwise(
            F.size(F.filter("_bounds", lambda b: b > pred)))).drop("_bounds")
        counts = x.groupBy(date, "_b").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy(date).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.select(date, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
        x = null_safe_join(x, offsets, [date, "_b"])
        w = Window.partitionBy(date, "_b").orderBy(*order)
        ranked = x.withColumn("prediction_rank", (F.col("_off") + F.row_number().over(w)).cast("int")) \
                  .drop("_b", "_off")
    return ranked.withColumn(
        "strategy_signal_rank", F.when(F.col("prediction_rank") <= top_n, F.lit(1)).otherwise(F.lit(0)))


def strategy_returns(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.withColumns({
        "strategy_return": F.col("strategy_signal") * F.col(label),
        "strategy_return_rank": F.col("strategy_signal_rank") * F.col(label),
        "market_return": F.col(label),
    })


_CUMS = {
    "cum_strategy_return": "strategy_return",
    "cum_strategy_return_rank": "strategy_return_rank",
    "cum_market_return": "market_return",
}


def _wealth_and_drawdown(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "drawdown": F.try_divide(F.col("strategy_wealth") - F.col("strategy_wealth_max"), F.col("strategy_wealth_max")),
        "drawdown_rank": F.try_divide(
            F.col("strategy_wealth_rank") - F.col("strategy_wealth_rank_max"), F.col("strategy_wealth_rank_max")),
    })


def cumulative(df: DataFrame, chunk_rows: int | None = None) -> DataFrame:
    """Running sums, wealth, running max wealth and drawdowns per symbol.

    Running maxima are taken on the cumulative return and exponentiated:
    exp is monotone, so max(exp(c)) == exp(max(c)) exactly.
    """
    if chunk_rows:
        from sparkfolio.operators.series import prefix_scan
        x = prefix_scan(df, _CUMS, {"_cmax": "cum_strategy_return", "_cmax_rank": "cum_strategy_return_rank"}, chunk_rows=chunk_rows)
    else:
        w = Window.partitionBy("symbol").orderBy("trade_date") \
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        x = df.withColumns({o: F.sum(c).over(w) for o, c in _CUMS.items()})
        x = x.withColumns({
            "_cmax": F.max("cum_strategy_return").over(w),
            "_cmax_rank": F.max("cum_strategy_return_rank").over(w),
        })
    x = x.withColumns({
        "strategy_wealth": F.exp("cum_strategy_return"),
        "strategy_wealth_rank": F.exp("cum_strategy_return_rank"),
        "market_wealth": F.exp("cum_market_return"),
        "strategy_wealth_max": F.exp("_cmax"),
        "strategy_wealth_rank_max": F.exp("_cmax_rank"),
    })
    return _wealth_and_drawdown(x).drop("_cmax", "_cmax_rank")


def backtest(predictions: DataFrame, threshold: float = THRESHOLD, top_n: int = TOP_N,
             extra_columns: list[str] | None = None, chunk_rows: int | None = None,
             rank_buckets: int | None = None) -> DataFrame:
    """Backtest table: the 19 backtest columns (+ ``extra_columns``, e.g. the
    11 model features, when present). ``chunk_rows`` splits long series and
    ``rank_buckets`` splits large daily cross-sections (both exact)."""
    extra = [c for c in (extra_columns or []) if c in predictions.columns and c not in BACKTEST_COLUMNS]
    # only what is returned travels through the shuffles
    x = predictions.select("symbol", "trade_date", "close", LABEL, "prediction", *extra)
    x = signal_strategy(x, threshold)
    x = daily_rank(x, top_n, split_buckets=rank_buckets)
    x = strategy_returns(x)
    x = cumulative(x, chunk_rows)
    return x.select(*BACKTEST_COLUMNS, *extra)
