"""Per-symbol backtest metrics.

One ``groupBy("symbol")`` aggregation (partial aggregation map-side, so a
hot symbol is pre-combined before the shuffle), then derived columns:

* totals are the MAXIMUM of the cumulative return over the period (not the
  last value; kept as the reference defines it)
* Sharpe = mean / sample stddev * sqrt(252), 0 when the stddev is 0 (null
  when the stddev is null, i.e. a single day)
* precision = true positives / positive predictions * 100, 0 when none
* alpha = strategy total - market total
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.schemas import (
    LABEL,
    METRICS_COLUMNS,
    SUMMARY_RANKING_COLUMNS,
    SUMMARY_SIGNAL_COLUMNS,
)

TRADING_DAYS = 252


def sharpe(avg: str, sd: str, days: int = TRADING_DAYS) -> Column:
    return F.when(F.col(sd) == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col(avg), F.col(sd)) * F.sqrt(F.lit(float(days))))


def metric_aggregates(backtest: DataFrame, label: str = LABEL) -> DataFrame:
    pos = F.col("prediction") > 0
    return backtest.groupBy("symbol").agg(
        F.max("cum_strategy_return").alias("total_strategy_return"),
        F.max("cum_market_return").alias("total_market_return"),
        F.max("cum_strategy_return_rank").alias("total_strategy_return_rank"),
        F.count("trade_date").alias("num_trading_days"),
        F.sum("strategy_signal").cast("bigint").alias("num_days_invested"),
        F.sum("strategy_signal_rank").cast("bigint").alias("num_days_invested_rank"),
        F.avg("strategy_return").alias("avg_daily_strategy_return"),
        F.avg("market_return").alias("avg_daily_market_return"),
        F.avg("strategy_return_rank").alias("avg_daily_strategy_return_rank"),
        F.stddev_samp("strategy_return").alias("stddev_strategy_return"),
        F.stddev_samp("market_return").alias("stddev_market_return"),
        F.stddev_samp("strategy_return_rank").alias("stddev_strategy_return_rank"),
        F.min("drawdown").alias("max_drawdown"),
        F.min("drawdown_rank").alias("max_drawdown_rank"),
        F.sum(F.when(pos & (F.col(label) > 0), F.lit(1)).otherwise(F.lit(0))).cast("bigint")
        .alias("true_positives"),
        F.sum(F.when(pos, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias("total_positive_predictions"),
    )


def derive_metrics(agg: DataFrame, days: int = TRADING_DAYS) -> DataFrame:
    return agg.withColumns({
        "sharpe_ratio": sharpe("avg_daily_strategy_return", "stddev_strategy_return", days),
        "sharpe_ratio_rank": sharpe("avg_daily_strategy_return_rank", "stddev_strategy_return_rank", days),
        "sharpe_ratio_market": sharpe("avg_daily_market_return", "stddev_market_return", days),
        "model_precision_pct": F.when(F.col("total_positive_predictions") == 0, F.lit(0.0)).otherwise(
            F.try_divide(F.col("true_positives"), F.col("total_positive_predictions")) * 100),
        "alpha": F.col("total_strategy_return") - F.col("total_market_return"),
        "alpha_rank": F.col("total_strategy_return_rank") - F.col("total_market_return"),
    })


def backtest_metrics(backtest: DataFrame, days: int = TRADING_DAYS, keep_counts: bool = False) -> DataFrame:
    """The 21-column metrics table (``keep_counts`` adds the precision counts)."""
    out = derive_metrics(metric_aggregates(backtest), days)
    cols = METRICS_COLUMNS + (["true_positives", "total_positive_predictions"] if keep_counts else [])
    return out.select(*cols)


def summary_signal(metrics: DataFrame) -> DataFrame:
    return metrics.select(*SUMMARY_SIGNAL_COLUMNS)


def summary_ranking(metrics: DataFrame) -> DataFrame:
    return metrics.select(*SUMMARY_RANKING_COLUMNS)
