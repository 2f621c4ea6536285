"""DuckDB SQL for the oracle check of every SQL-expressible query.

Written independently of the Spark code, directly from the semantics
(reference-style formulations where they differ from ours, e.g. the as-of
join is a range join + ``row_number`` here). Views ``lineitem``, ``part``
etc. are pre-registered by the checker. Every double on output is rounded
to 6 places (``R(x)``), integers are BIGINT.
"""

from __future__ import annotations


def R(expr: str, alias: str) -> str:
    """Round a double output to 6 places, normalising -0.0 to 0.0."""
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0 AS {alias}"


W = "WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)"

CTES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, sql: str, deps: list[str] = ()) -> None:
    CTES[name] = sql
    DEPS[name] = list(deps)


# ---------------------------------------------------------------- fixtures
cte("bars", """
SELECT p.p_brand AS symbol, CAST(l.l_shipdate AS DATE) AS trade_date,
       first(p.p_retailprice ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey) AS "open",
       max(p.p_retailprice) AS high,
       min(p.p_retailprice) AS low,
       last(p.p_retailprice ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey) AS "close",
       CAST(sum(l.l_quantity) AS BIGINT) AS volume
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY p.p_brand, CAST(l.l_shipdate AS DATE)""")

cte("fund_in", """
SELECT p.p_brand AS symbol,
       CAST(CAST(date_trunc('quarter', l.l_shipdate) AS DATE) + INTERVAL 3 MONTH AS DATE) AS report_date,
       CAST(sum(CAST(l.l_quantity AS BIGINT)) AS DOUBLE) / count(*) AS pe_ratio,
       max(l.l_extendedprice) / min(l.l_extendedprice) AS debt_to_equity,
       DATE '2002-02-01' AS effective_date, 'fmp' AS source_api,
       TIMESTAMP '2002-02-01 06:00:00' AS ingestion_ts
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1, 2""")

cte("fund", """
SELECT *, TRUE AS is_current, CAST(NULL AS DATE) AS expiration_date FROM fund_in""", ["fund_in"])

cte("fund_old", """
SELECT symbol, report_date,
       CASE WHEN month(report_date) = 4 THEN pe_ratio + 1 ELSE pe_ratio END AS pe_ratio,
       CASE WHEN month(report_date) = 7 THEN NULL ELSE debt_to_equity END AS debt_to_equity,
       DATE '2000-01-01' AS effective_date, source_api,
       TIMESTAMP '2000-01-01 06:00:00' AS ingestion_ts,
       TRUE AS is_current, CAST(NULL AS DATE) AS expiration_date
FROM fund WHERE report_date < DATE '2000-01-01'""", ["fund"])

cte("lbars", f"""
SELECT *, CASE WHEN "close" = 0 THEN 0.0
               ELSE (lead("close") OVER w - "close") / "close" END AS target_return_next_day
FROM bars {W}""", ["bars"])

cte("pred_all", """
SELECT *, ("close" - "open") / "close" AS prediction FROM lbars
WHERE target_return_next_day IS NOT NULL""", ["lbars"])
cte("pred", "SELECT * FROM pred_all WHERE trade_date >= DATE '2000-01-01'", ["pred_all"])

cte("raw_bars", """
SELECT strftime(trade_date, '%Y-%m') AS dt, symbol,
       CASE WHEN day(trade_date) = 17 THEN 'bad' ELSE strftime(trade_date, '%Y-%m-%d') END AS datetime,
       CASE WHEN day(trade_date) = 19 THEN CAST(high + 1 AS VARCHAR) ELSE CAST("open" AS VARCHAR) END AS "open",
       CAST(high AS VARCHAR) AS high,
       CASE WHEN day(trade_date) = 23 THEN CAST("close" + 1 AS VARCHAR) ELSE CAST(low AS VARCHAR) END AS low,
       CASE WHEN day(trade_date) = 5 THEN 'n/a' WHEN day(trade_date) = 9 THEN '-1'
            ELSE CAST("close" AS VARCHAR) END AS "close",
       CASE WHEN day(trade_date) = 11 THEN NULL ELSE CAST(volume AS VARCHAR) END AS volume
FROM bars""", ["bars"])

cte("flat", """
SELECT dt, symbol, TRY_CAST(datetime AS DATE) AS trade_date,
       TRY_CAST("open" AS DOUBLE) AS "open", TRY_CAST(high AS DOUBLE) AS high,
       TRY_CAST(low AS DOUBLE) AS low, TRY_CAST("close" AS DOUBLE) AS "close",
       TRY_CAST(volume AS BIGINT) AS volume
FROM raw_bars""", ["raw_bars"])

cte("checked", """
SELECT *, CASE WHEN "close" IS NULL OR "close" < 0 THEN FALSE
               WHEN volume IS NULL OR volume < 0 THEN FALSE
               WHEN trade_date IS NULL THEN FALSE
               WHEN "open" > high THEN FALSE
               WHEN low > "close" THEN FALSE
               ELSE TRUE END AS is_valid
FROM flat""", ["flat"])

# ---------------------------------------------------------------- as-of + features
cte("rep", """
SELECT symbol, report_date, pe_ratio, debt_to_equity FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, report_date
                               ORDER BY effective_date DESC, ingestion_ts DESC) AS rn
  FROM fund WHERE is_current) WHERE rn = 1""", ["fund"])

cte("asofj", """
SELECT symbol, trade_date, "open", high, low, "close", volume, pe_ratio, debt_to_equity FROM (
  SELECT b.*, r.pe_ratio, r.debt_to_equity,
         row_number() OVER (PARTITION BY b.symbol, b.trade_date ORDER BY r.report_date DESC NULLS LAST) AS rn
  FROM bars b LEFT JOIN rep r ON b.symbol = r.symbol AND r.report_date <= b.trade_date)
WHERE rn = 1""", ["bars", "rep"])

cte("ind1", f"""
SELECT *,
  avg("close") OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS sma_20,
  stddev_samp("close") OVER (w ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS sd_20,
  avg("close") OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS ema_12,
  avg("close") OVER (w ROWS BETWEEN 25 PRECEDING AND CURRENT ROW) AS ema_26,
  "close" - lag("close", 1) OVER w AS diff,
  ln("close" / lag("close", 1) OVER w) AS daily_return,
  lead("close", 1) OVER w AS next_close
FROM asofj {W}""", ["asofj"])

cte("ind2", f"""
SELECT *,
  sma_20 + sd_20 * 2 AS bollinger_upper, sma_20 - sd_20 * 2 AS bollinger_lower,
  ema_12 - ema_26 AS macd_line, ema_12 - ema_26 AS sma_diff,
  avg(CASE WHEN diff > 0 THEN diff ELSE 0.0 END) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS avg_gain,
  avg(CASE WHEN diff < 0 THEN abs(diff) ELSE 0.0 END) OVER (w ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS avg_loss,
  lag(daily_return, 1) OVER w AS return_lag_1,
  lag(daily_return, 2) OVER w AS return_lag_2,
  lag(daily_return, 3) OVER w AS return_lag_3,
  stddev_samp(daily_return) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS volatility_10d
FROM ind1 {W}""", ["ind1"])

cte("ind", """
SELECT *,
  100 - 100 / (1 + avg_gain / CASE WHEN avg_loss = 0 THEN 1 ELSE avg_loss END) AS rsi_14,
  CASE WHEN bollinger_upper - bollinger_lower = 0 THEN 0.0
       ELSE ("close" - bollinger_lower) / (bollinger_upper - bollinger_lower) END AS pct_b,
  CASE WHEN "close" = 0 THEN 0.0 ELSE (next_close - "close") / "close" END AS target_return_next_day
FROM ind2""", ["ind2"])

cte("gold", """
SELECT symbol, trade_date, "close", volume,
  coalesce(rsi_14, 0) AS rsi_14, coalesce(macd_line, 0) AS macd_line, coalesce(sma_diff, 0) AS sma_diff,
  coalesce(return_lag_1, 0) AS return_lag_1, coalesce(return_lag_2, 0) AS return_lag_2,
  coalesce(return_lag_3, 0) AS return_lag_3, coalesce(volatility_10d, 0) AS volatility_10d,
  coalesce(pct_b, 0) AS pct_b, coalesce(pe_ratio, 0) AS pe_ratio,
  coalesce(debt_to_equity, 0) AS debt_to_equity, target_return_next_day,
  'silver_prices + silver_fundamentals' AS data_lineage
FROM ind WHERE trade_date IS NOT NULL AND "close" IS NOT NULL""", ["ind"])

# ---------------------------------------------------------------- backtest
cte("bt1", """
SELECT *, CASE WHEN prediction > -0.005 THEN 1 ELSE 0 END AS strategy_signal,
       row_number() OVER (PARTITION BY trade_date ORDER BY prediction DESC NULLS LAST, symbol) AS prediction_rank
FROM pred""", ["pred"])

cte("bt2", """
SELECT *, CASE WHEN prediction_rank <= 6 THEN 1 ELSE 0 END AS strategy_signal_rank,
       strategy_signal * target_return_next_day AS strategy_return,
       (CASE WHEN prediction_rank <= 6 THEN 1 ELSE 0 END) * target_return_next_day AS strategy_return_rank,
       target_return_next_day AS market_return
FROM bt1""", ["bt1"])

cte("bt3", f"""
SELECT *,
  sum(strategy_return) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_strategy_return,
  sum(strategy_return_rank) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_strategy_return_rank,
  sum(market_return) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_market_return
FROM bt2 {W}""", ["bt2"])

cte("bt4", f"""
SELECT *, exp(cum_strategy_return) AS strategy_wealth, exp(cum_strategy_return_rank) AS strategy_wealth_rank,
       exp(cum_market_return) AS market_wealth,
       max(exp(cum_strategy_return)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wmax,
       max(exp(cum_strategy_return_rank)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS wmax_rank
FROM bt3 {W}""", ["bt3"])

cte("bt", """
SELECT *, (strategy_wealth - wmax) / wmax AS drawdown, (strategy_wealth_rank - wmax_rank) / wmax_rank AS drawdown_rank
FROM bt4""", ["bt4"])

cte("magg", """
SELECT symbol,
  max(cum_strategy_return) AS total_strategy_return,
  max(cum_market_return) AS total_market_return,
  max(cum_strategy_return_rank) AS total_strategy_return_rank,
  count(trade_date) AS num_trading_days,
  CAST(sum(strategy_signal) AS BIGINT) AS num_days_invested,
  CAST(sum(strategy_signal_rank) AS BIGINT) AS num_days_invested_rank,
  avg(strategy_return) AS avg_daily_strategy_return,
  avg(market_return) AS avg_daily_market_return,
  avg(strategy_return_rank) AS avg_daily_strategy_return_rank,
  stddev_samp(strategy_return) AS stddev_strategy_return,
  stddev_samp(market_return) AS stddev_market_return,
  stddev_samp(strategy_return_rank) AS stddev_strategy_return_rank,
  min(drawdown) AS max_drawdown, min(drawdown_rank) AS max_drawdown_rank,
  CAST(sum(CASE WHEN prediction > 0 AND target_return_next_day > 0 THEN 1 ELSE 0 END) AS BIGINT) AS true_positives,
  CAST(sum(CASE WHEN prediction > 0 THEN 1 ELSE 0 END) AS BIGINT) AS total_positive_predictions
FROM bt GROUP BY symbol""", ["bt"])

cte("metrics", """
SELECT *,
  CASE WHEN stddev_strategy_return = 0 THEN 0.0
       ELSE avg_daily_strategy_return / stddev_strategy_return * sqrt(252.0) END AS sharpe_ratio,
  CASE WHEN stddev_strategy_return_rank = 0 THEN 0.0
       ELSE avg_daily_strategy_return_rank / stddev_strategy_return_rank * sqrt(252.0) END AS sharpe_ratio_rank,
  CASE WHEN stddev_market_return = 0 THEN 0.0
       ELSE avg_daily_market_return / stddev_market_return * sqrt(252.0) END AS sharpe_ratio_market,
  CASE WHEN total_positive_predictions = 0 THEN 0.0
       ELSE CAST(true_positives AS DOUBLE) / total_positive_predictions * 100 END AS model_precision_pct,
  total_strategy_return - total_market_return AS alpha,
  total_strategy_return_rank - total_market_return AS alpha_rank
FROM magg""", ["magg"])


def with_ctes(body: str, *needs: str) -> str:
    """Prefix ``body`` with the CTEs it needs (transitively, in order)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in DEPS[n]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    return f"WITH {parts}\n{body.strip()}"


def rcols(cols: list[str], prefix: str = "") -> str:
    return ", ".join(R(f'{prefix}"{c}"', f'"{c}"') for c in cols)
