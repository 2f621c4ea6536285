"""Table schemas (raw, silver, gold, serving)."""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()
DT, TS = T.DateType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw price document: one JSON object with meta + values[], every leaf a string.
RAW_PRICES = _struct(
    ("meta", _struct(("symbol", S), ("interval", S))),
    ("values", T.ArrayType(_struct(
        ("datetime", S), ("open", S), ("high", S), ("low", S), ("close", S), ("volume", S),
    ))),
)

# Raw ratios: JSON array of flat objects; these four fields are the ones read.
RAW_RATIOS_FIELDS = {
    "symbol": S,
    "date": S,
    "priceToEarningsRatio": D,
    "debtToEquityRatio": D,
}
RAW_RATIOS = _struct(*RAW_RATIOS_FIELDS.items())

SILVER_PRICES = _struct(
    ("symbol", S), ("trade_date", DT), ("open", D), ("high", D), ("low", D), ("close", D),
    ("volume", L), ("ingestion_ts", TS), ("source_api", S), ("ingestion_date", DT),
)

SILVER_FUNDAMENTALS = _struct(
    ("symbol", S), ("report_date", DT), ("pe_ratio", D), ("debt_to_equity", D),
    ("effective_date", DT), ("source_api", S), ("ingestion_ts", TS),
    ("is_current", B), ("expiration_date", DT),
)

FEATURES = [
    "rsi_14", "macd_line", "sma_diff", "pct_b",
    "pe_ratio", "debt_to_equity", "volume",
    "return_lag_1", "return_lag_2", "return_lag_3", "volatility_10d",
]
LABEL = "target_return_next_day"

GOLD_COLUMNS = [
    "symbol", "trade_date", "close", "volume", "rsi_14", "macd_line", "sma_diff",
    "return_lag_1", "return_lag_2", "return_lag_3", "volatility_10d", "pct_b",
    "pe_ratio", "debt_to_equity", LABEL, "data_lineage",
]

BACKTEST_COLUMNS = [
    "symbol", "trade_date", "close", LABEL, "prediction", "prediction_rank",
    "strategy_signal", "strategy_signal_rank",
    "strategy_return", "strategy_return_rank", "market_return",
    "cum_strategy_return", "cum_strategy_return_rank", "cum_market_return",
    "strategy_wealth", "strategy_wealth_rank", "market_wealth",
    "drawdown", "drawdown_rank",
]

METRICS_COLUMNS = [
    "symbol",
    "total_strategy_return", "total_strategy_return_rank", "total_market_return",
    "alpha", "alpha_rank",
    "num_trading_days", "num_days_invested", "num_days_invested_rank",
    "avg_daily_strategy_return", "avg_daily_strategy_return_rank", "avg_daily_market_return",
    "stddev_strategy_return", "stddev_strategy_return_rank", "stddev_market_return",
    "sharpe_ratio", "sharpe_ratio_rank", "sharpe_ratio_market",
    "max_drawdown", "max_drawdown_rank",
    "model_precision_pct",
]

SUMMARY_SIGNAL_COLUMNS = [
    "symbol", "total_strategy_return", "total_market_return", "alpha",
    "sharpe_ratio", "sharpe_ratio_market", "max_drawdown", "model_precision_pct",
]
SUMMARY_RANKING_COLUMNS = [
    "symbol", "total_strategy_return_rank", "total_market_return", "alpha_rank",
    "sharpe_ratio_rank", "sharpe_ratio_market", "max_drawdown_rank",
]

FUTURE_COLUMNS = ["symbol", "trade_date", "close", "prediction", "recommendation", "prediction_pct"]

# Serving schemas (declared columns of the external tables).
SERVING_BACKTEST = _struct(
    ("symbol", S), ("trade_date", DT), ("close", D), (LABEL, D), ("prediction", D),
    ("strategy_signal", L), ("strategy_return", D), ("market_return", D),
    ("cum_strategy_return", D), ("cum_market_return", D),
    ("strategy_wealth", D), ("market_wealth", D), ("drawdown", D),
)
SERVING_METRICS = _struct(
    ("symbol", S), ("total_strategy_return", D), ("total_market_return", D), ("alpha", D),
    ("num_trading_days", L), ("num_days_invested", L),
    ("avg_daily_strategy_return", D), ("avg_daily_market_return", D),
    ("stddev_strategy_return", D), ("stddev_market_return", D),
    ("sharpe_ratio", D), ("sharpe_ratio_market", D), ("max_drawdown", D),
    ("model_precision_pct", D),
)
SERVING_FUTURE = _struct(
    ("symbol", S), ("trade_date", DT), ("close", D), ("prediction", D),
    ("recommendation", S), ("prediction_pct", D),
)
