"""Rolling technical indicators per series.

All indicators share ONE window spec (partition keys + order), so Catalyst
plans a single Exchange + Sort + Window for the whole block. Frames are ROWS
frames looking back at most 25 rows; for very long series the same functions
run unchanged on chunked input (see :mod:`sparkfolio.operators.series`),
where the partition keys are ``(symbol, chunk)`` and the order is a row index.

Formulas are fixed by the reference's semantics:

* ``sma_20``: mean of the last 20 closes; Bollinger bands = sma_20 +/- 2 sample
  stddev over the same 20 rows.
* ``ema_12`` / ``ema_26``: simple rolling means of 12 / 26 rows (an
  approximation of an exponential average, kept as is), ``macd_line`` is
  their difference and ``sma_diff`` the same difference.
* ``rsi_14``: gains/losses from the one-row difference (first row counts as
  gain = loss = 0), averaged over 14 rows; a zero average loss is replaced by
  1, so an all-gain window is not 100 and a flat window gives 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

DEFAULT_KEYS: tuple[str, ...] = ("symbol",)
DEFAULT_ORDER = "trade_date"

# Lookback (rows before the current one) needed by every column of this
# module and of features.py; the chunked evaluation copies this many rows
# from the previous chunk.
MAX_LOOKBACK = 25
MAX_LOOKAHEAD = 1


def series_window(keys: Sequence[str] = DEFAULT_KEYS, order: str = DEFAULT_ORDER) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(order)


def rolling_mean(col: str | Column, n: int, w: WindowSpec) -> Column:
    return F.avg(col).over(w.rowsBetween(-(n - 1), 0))


def rolling_stddev(col: str | Column, n: int, w: WindowSpec) -> Column:
    """Sample standard deviation over the last n rows (null for a 1-row frame)."""
    return F.stddev_samp(col).over(w.rowsBetween(-(n - 1), 0))


def bollinger(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, order: str = DEFAULT_ORDER,
              price: str = "close", n: int = 20, k: float = 2.0) -> DataFrame:
    w = series_window(keys, order)
    sma = rolling_mean(price, n, w)
    sd = rolling_stddev(price, n, w)
    return df.withColumns({
        "sma_20": sma,
        "bollinger_upper": sma + sd * k,
        "bollinger_lower": sma - sd * k,
    })


def macd(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, order: str = DEFAULT_ORDER,
         price: str = "close", fast: int = 12, slow: int = 26) -> DataFrame:
    w = series_window(keys, order)
    fast_m = rolling_mean(price, fast, w)
    slow_m = rolling_mean(price, slow, w)
    return df.withColumns({
        "ema_12": fast_m,
        "ema_26": slow_m,
        "macd_line": fast_m - slow_m,
        "sma_diff": fast_m - slow_m,
    })


def rsi(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS, order: str = DEFAULT_ORDER,
        price: str = "close", n: int = 14) -> DataFrame:
    w = series_window(keys, order)
    diff = F.col(price) - F.lag(price, 1).over(w)
    tmp = df.withColumn("_diff", diff).withColumns({
        "_gain": F.when(F.col("_diff") > 0, F.col("_diff")).otherwise(F.lit(0.0)),
        "_loss": F.when(F.col("_diff") < 0, F.abs(F.col("_diff"))).otherwise(F.lit(0.0)),
    })
    avg_gain = rolling_mean("_gain", n, w)
    avg_loss = rolling_mean("_loss", n, w)
    rs = avg_gain / F.when(avg_loss == 0, F.lit(1.0)).otherwise(avg_loss)
    return tmp.withColumn("rsi_14", F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs)) \
              .drop("_diff", "_gain", "_loss")


def technical_indicators(df: DataFrame, keys: Sequence[str] = DEFAULT_KEYS,
                         order: str = DEFAULT_ORDER, price: str = "close") -> DataFrame:
    """sma_20, bollinger_upper/lower, ema_12, ema_26, macd_line, sma_diff, rsi_14."""
    out = bollinger(df, keys, order, price)
    out = macd(out, keys, order, price)
    return rsi(out, keys, order, price)


def lags(df: DataFrame, col: str, n: int, keys: Sequence[str] = DEFAULT_KEYS,
         order: str = DEFAULT_ORDER, prefix: str | None = None) -> DataFrame:
    w = series_window(keys, order)
    prefix = prefix or f"{col}_lag_"
    return df.withColumns({f"{prefix}{i}": F.lag(col, i).over(w) for i in range(1, n + 1)})


def lead(col: str, n: int, keys: Sequence[str] = DEFAULT_KEYS, order: str = DEFAULT_ORDER) -> Column:
    return F.lead(col, n).over(series_window(keys, order))
