"""Model features and label per series.

``daily_return``  ln(close / previous close), null on the first row or when
                  the ratio is not positive
``return_lag_k``  daily_return k rows back, k = 1..3
``volatility_10d``  sample stddev of the last 10 daily returns
``pct_b``         (close - lower) / (upper - lower); 0 when the band width is
                  0, null (later filled with 0) when the width is null
``target_return_next_day``  (next close - close) / close, 0 when close is 0,
                  null on the last row of a series (never filled)

:func:`gold_features` composes as-of join -> indicators -> features -> fill ->
drop into the 16-column feature table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.functions.columns import safe_div
from sparkfolio.operators import indicators as ind
from sparkfolio.operators.indicators import DEFAULT_KEYS, DEFAULT_ORDER, series_window
from sparkfolio.operators.quality import drop_missing, fill_missing
from sparkfolio.schemas import GOLD_COLUMNS, LABEL

LINEAGE = "silver_prices + silver_fundamentals"
FILL_COLUMNS = [
    "pe_ratio", "debt_to_equity", "rsi_14", "macd_line", "sma_diff", "pct_b",
    "return_lag_1", "return_lag_2", "return_lag_3", "volatility_10d",
]


def log_return(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, order: str = DEFAULT_ORDER,
               price: str = "close") -> DataFrame:
    w = series_window(keys, order)
    return df.withColumn("daily_return", F.ln(safe_div(F.col(price), F.lag(price, 1).over(w))))


def return_lags(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, order: str = DEFAULT_ORDER,
                n: int = 3) -> DataFrame:
    return ind.lags(df, "daily_return", n, keys, order, prefix="return_lag_")


def volatility(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, order: str = DEFAULT_ORDER,
               n: int = 10) -> DataFrame:
    w = series_window(keys, order)
    return df.withColumn("volatility_10d", ind.rolling_stddev("daily_return", n, w))


def pct_b_expr(close: str = "close", upper: str = "bollinger_upper",
               lower: str = "bollinger_lower") -> Column:
    width = F.col(upper) - F.col(lower)
    return F.when(width == 0, F.lit(0.0)).otherwise(safe_div(F.col(close) - F.col(lower), width))


def next_day_return_expr(keys: Sequence[str] = DEFAULT_KEYS, order: str = DEFAULT_ORDER,
                         price: str = "close") -> Column:
    nxt = ind.lead(price, 1, keys, order)
    return F.when(F.col(price) == 0, F.lit(0.0)).otherwise(
        safe_div(nxt - F.col(price), F.col(price)))


def feature_columns(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS,
                    order: str = DEFAULT_ORDER) -> DataFrame:
    """Indicators + returns + label on a deduplicated series with pe/de columns.

    Returns every intermediate column; :func:`finish_features` projects them.
    """
    out = ind.technical_indicators(df, keys, order)
    out = log_return(out, keys, order)
    out = return_lags(out, keys, order)
    out = volatility(out, keys, order)
    return out.withColumns({
        "pct_b": pct_b_expr(),
        LABEL: next_day_return_expr(keys, order),
        "data_lineage": F.lit(LINEAGE),
    })


def finish_features(df: DataFrame) -> DataFrame:
    """Project to the 16 gold columns, fill missing features with 0, drop rows
    without a date or close (the label is never filled)."""
    out = df.select(*GOLD_COLUMNS)
    out = fill_missing(out, FILL_COLUMNS)
    return drop_missing(out, ["trade_date", "close"])


def gold_features(prices: DataFrame, fundamentals: DataFrame, **asof_kwargs) -> DataFrame:
    """Feature table: point-in-time join of prices and current fundamentals,
    then indicators, features and the next-day label (one row per symbol/date).

    ``asof_kwargs`` go to :func:`sparkfolio.operators.asof.asof_join_fundamentals`.
    Pass ``chunk_rows`` to evaluate the windows over chunked series
    (bounded task size for arbitrarily long series).
    """
    from sparkfolio.operators.asof import asof_join_fundamentals
    from sparkfolio.operators.series import chunked_apply

    chunk_rows = asof_kwargs.pop("chunk_rows", None)
    joined = asof_join_fundamentals(prices, fundamentals, **asof_kwargs)
    if chunk_rows:
        full = chunked_apply(joined, feature_columns, chunk_rows=chunk_rows)
    else:
        full = feature_columns(joined)
    return finish_features(full)
