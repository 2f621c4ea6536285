"""DuckDB oracle SQL per registered query key (see ``plans/oracle.py``)."""

from __future__ import annotations

from sparkfolio.plans.oracle import R, W, cte, rcols, with_ctes
from sparkfolio.schemas import BACKTEST_COLUMNS, FEATURES, LABEL, METRICS_COLUMNS

ORACLE: dict[str, str] = {}


def oracle(name: str, body: str, *needs: str) -> None:
    ORACLE[name] = with_ctes(body, *needs)


RB = "ROWS BETWEEN {n} PRECEDING AND CURRENT ROW"

# ------------------------------------------------------------------ windows / indicators
oracle("rolling_mean", f"""
SELECT symbol, trade_date,
  {R('avg("close") OVER (w ' + RB.format(n=11) + ')', 'mean_12')},
  {R('avg("close") OVER (w ' + RB.format(n=19) + ')', 'mean_20')},
  {R('avg("close") OVER (w ' + RB.format(n=25) + ')', 'mean_26')}
FROM bars {W}""", "bars")

oracle("rolling_stddev", f"""
SELECT symbol, trade_date,
  {R('stddev_samp("close") OVER (w ' + RB.format(n=19) + ')', 'stddev_20')},
  {R('stddev_samp(daily_return) OVER (w ' + RB.format(n=9) + ')', 'stddev_ret_10')}
FROM (SELECT *, ln("close" / lag("close") OVER w) AS daily_return FROM bars {W}) {W}""", "bars")

oracle("log_return", f"""
SELECT symbol, trade_date, {R('"close"', '"close"')}, {R('daily_return', 'daily_return')}
FROM ind1""", "ind1")

oracle("return_lags", f"""
SELECT symbol, trade_date, {rcols(['daily_return', 'return_lag_1', 'return_lag_2', 'return_lag_3'])}
FROM ind""", "ind")

oracle("volatility", f"SELECT symbol, trade_date, {R('volatility_10d', 'volatility_10d')} FROM ind", "ind")

oracle("next_day_return", f"""
SELECT symbol, trade_date, {rcols(['close', 'target_return_next_day'])} FROM lbars""", "lbars")

oracle("bollinger", f"""
SELECT symbol, trade_date, {rcols(['close', 'sma_20', 'bollinger_upper', 'bollinger_lower'])} FROM ind""", "ind")

oracle("macd", f"""
SELECT symbol, trade_date, {rcols(['ema_12', 'ema_26', 'macd_line', 'sma_diff'])} FROM ind""", "ind")

oracle("rsi", f"SELECT symbol, trade_date, {rcols(['close', 'rsi_14'])} FROM ind", "ind")

oracle("pct_b", f"SELECT symbol, trade_date, {R('pct_b', 'pct_b')} FROM ind", "ind")

# ------------------------------------------------------------------ as-of / features
ASOF = f"""
SELECT symbol, trade_date, {rcols(['open', 'high', 'low', 'close'])}, volume,
       {rcols(['pe_ratio', 'debt_to_equity'])}
FROM asofj"""
oracle("asof_join", ASOF, "asofj")
oracle("asof_join_union", ASOF, "asofj")
oracle("asof_join_shuffle", ASOF, "asofj")

oracle("first_per_group", f"""
SELECT symbol, report_date, {rcols(['pe_ratio', 'debt_to_equity'])} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY report_date DESC) AS rn FROM fund)
WHERE rn = 1""", "fund")

GOLD = f"""
SELECT symbol, trade_date, {R('"close"', '"close"')}, volume,
  {rcols(['rsi_14', 'macd_line', 'sma_diff', 'return_lag_1', 'return_lag_2', 'return_lag_3',
          'volatility_10d', 'pct_b', 'pe_ratio', 'debt_to_equity', 'target_return_next_day'])},
  data_lineage
FROM gold"""
oracle("gold_features", GOLD, "gold")
oracle("gold_features_chunked", GOLD, "gold")

# ------------------------------------------------------------------ backtest / metrics
oracle("signal_strategy", f"""
SELECT symbol, trade_date, {R('prediction', 'prediction')},
       CAST(CASE WHEN prediction > -0.005 THEN 1 ELSE 0 END AS BIGINT) AS strategy_signal
FROM pred_all""", "pred_all")

oracle("daily_rank", f"""
SELECT symbol, trade_date, {R('prediction', 'prediction')}, CAST(n AS BIGINT) AS prediction_rank,
       CAST(CASE WHEN n <= 6 THEN 1 ELSE 0 END AS BIGINT) AS strategy_signal_rank
FROM (SELECT *, row_number() OVER (PARTITION BY trade_date ORDER BY prediction DESC NULLS LAST, symbol) AS n FROM pred_all)""", "pred_all")

ORACLE["daily_rank_split"] = ORACLE["daily_rank"]

oracle("strategy_returns", f"""
SELECT symbol, trade_date, {rcols(['strategy_return', 'strategy_return_rank', 'market_return'])} FROM bt""", "bt")

oracle("cumulative_return", f"""
SELECT symbol, trade_date, {rcols(['cum_strategy_return', 'cum_strategy_return_rank', 'cum_market_return'])}
FROM bt""", "bt")

oracle("wealth", f"""
SELECT symbol, trade_date, {rcols(['strategy_wealth', 'strategy_wealth_rank', 'market_wealth'])} FROM bt""", "bt")

oracle("drawdown", f"SELECT symbol, trade_date, {rcols(['drawdown', 'drawdown_rank'])} FROM bt", "bt")

_BT_INT = {"prediction_rank", "strategy_signal", "strategy_signal_rank"}
_BT_OTHER = {"symbol", "trade_date"}


def _cols(cols, ints=(), other=("symbol", "trade_date")):
    parts = []
    for c in cols:
        if c in other:
            parts.append(f'"{c}"')
        elif c in ints:
            parts.append(f'CAST("{c}" AS BIGINT) AS "{c}"')
        else:
            parts.append(R(f'"{c}"', f'"{c}"'))
    return ", ".join(parts)


BACKTEST = f"SELECT {_cols(BACKTEST_COLUMNS, _BT_INT)} FROM bt"
oracle("backtest", BACKTEST, "bt")
oracle("backtest_chunked", BACKTEST, "bt")

_M_INT = {"num_trading_days", "num_days_invested", "num_days_invested_rank",
          "true_positives", "total_positive_predictions"}


def metrics_sql(cols):
    return f"SELECT {_cols(cols, _M_INT, ('symbol',))} FROM metrics"


oracle("backtest_metrics", metrics_sql(METRICS_COLUMNS), "metrics")
oracle("precision_counts", metrics_sql(["symbol", "true_positives", "total_positive_predictions"]), "metrics")
oracle("precision", metrics_sql(["symbol", "model_precision_pct"]), "metrics")
oracle("sharpe", metrics_sql(["symbol", "sharpe_ratio", "sharpe_ratio_rank", "sharpe_ratio_market"]), "metrics")
oracle("summary_signal", metrics_sql([
    "symbol", "total_strategy_return", "total_market_return", "alpha",
    "sharpe_ratio", "sharpe_ratio_market", "max_drawdown", "model_precision_pct"]), "metrics")
oracle("summary_ranking", metrics_sql([
    "symbol", "total_strategy_return_rank", "total_market_return", "alpha_rank",
    "sharpe_ratio_rank", "sharpe_ratio_market", "max_drawdown_rank"]), "metrics")


# ------------------------------------------------------------------ quality / flatten / scans

PX = f'symbol, trade_date, {rcols(["open", "high", "low", "close"])}, volume'
LINEAGE = "'twelvedata' AS source_api, DATE '2002-02-01' AS ingestion_date"

oracle("price_flatten", f"SELECT {PX}, {LINEAGE} FROM flat", "flat")
oracle("dq_validate", f"SELECT {PX}, is_valid FROM checked", "checked")
oracle("dq_counts", """
SELECT symbol, count(*) FILTER (WHERE is_valid) AS valid_rows, count(*) FILTER (WHERE NOT is_valid) AS invalid_rows
FROM checked GROUP BY symbol""", "checked")
oracle("dq_invalid_sample", f"""
SELECT {PX} FROM checked WHERE NOT is_valid
ORDER BY symbol, trade_date NULLS LAST, "open" NULLS LAST, high NULLS LAST, low NULLS LAST,
         "close" NULLS LAST, volume NULLS LAST
LIMIT 10""", "checked")
oracle("silver_prices", f"SELECT {PX}, {LINEAGE} FROM checked WHERE is_valid", "checked")
oracle("null_report", """
SELECT count(*) FILTER (WHERE trade_date IS NULL) AS nb_null_trade_date,
       count(*) FILTER (WHERE "open" IS NULL) AS nb_null_open,
       count(*) FILTER (WHERE high IS NULL) AS nb_null_high,
       count(*) FILTER (WHERE low IS NULL) AS nb_null_low,
       count(*) FILTER (WHERE "close" IS NULL) AS nb_null_close,
       count(*) FILTER (WHERE volume IS NULL) AS nb_null_volume
FROM flat""", "flat")
oracle("drop_missing", f"""
SELECT {PX} FROM flat WHERE trade_date IS NOT NULL AND "close" IS NOT NULL AND volume IS NOT NULL""", "flat")
oracle("fill_missing", f"""
SELECT symbol, trade_date, {R('coalesce("open", 0)', '"open"')}, {rcols(["high", "low"])},
       {R('coalesce("close", 0)', '"close"')}, coalesce(volume, 0) AS volume
FROM flat""", "flat")
oracle("empty_like", f"SELECT {PX} FROM bars", "bars")
oracle("row_counts", """
SELECT (SELECT count(*) FROM bars) AS bars_rows, (SELECT count(*) FROM fund) AS fund_rows,
       (SELECT count(*) FROM pred) AS pred_rows, (SELECT count(*) FROM flat) AS raw_price_rows""",
       "bars", "fund", "pred", "flat")
oracle("scan_json_nested", f"SELECT {PX} FROM flat", "flat")
oracle("scan_partition_pruned", f"SELECT {PX} FROM flat WHERE dt BETWEEN '1998-01' AND '1998-12'", "flat")
oracle("scan_json_array", f"""
SELECT symbol, strftime(report_date, '%Y-%m-%d') AS "date",
       {R('pe_ratio', '"priceToEarningsRatio"')}, {R('debt_to_equity', '"debtToEquityRatio"')}
FROM fund_in""", "fund_in")
STD = f"symbol, report_date, {rcols(['pe_ratio', 'debt_to_equity'])}, effective_date, source_api"
oracle("fund_standardize", f"SELECT {STD} FROM fund_in", "fund_in")
oracle("ensure_columns", f"""
SELECT symbol, report_date, {R('pe_ratio', 'pe_ratio')}, CAST(NULL AS DOUBLE) AS debt_to_equity,
       effective_date, source_api FROM fund_in""", "fund_in")
oracle("scan_parquet", f"SELECT {PX} FROM bars", "bars")

cte("batch2", """
SELECT symbol, trade_date, "close", 'rerun' AS source_api FROM bars
WHERE year(trade_date) = 2001 AND symbol <> (SELECT min(symbol) FROM bars)""", ["bars"])
oracle("sink_dynamic_overwrite", f"""
SELECT symbol, trade_date, {R('"close"', '"close"')}, source_api FROM (
  SELECT symbol, trade_date, "close", 'twelvedata' AS source_api FROM bars
  WHERE trade_date NOT IN (SELECT trade_date FROM batch2)
  UNION ALL SELECT * FROM batch2)""", "bars", "batch2")
oracle("sink_replace", f"""
SELECT symbol, trade_date, {R('"close"', '"close"')}, volume FROM bars WHERE trade_date >= DATE '2000-01-01'""",
       "bars")

# ------------------------------------------------------------------ landing
cte("payload_keys", """
SELECT 'prices' AS source, dt, symbol, '{"meta": {"symbol": "' || symbol || '"}, "values": []}' AS body
FROM (SELECT DISTINCT dt, symbol FROM raw_bars)
UNION ALL
SELECT 'ratios', strftime(report_date, '%Y'), symbol, '[{"symbol": "' || symbol || '"}]'
FROM (SELECT DISTINCT report_date, symbol FROM fund_in) GROUP BY 2, 3
UNION ALL SELECT 'prices', '2002-12', symbol, '{"status": "error", "message": "rate limit"}'
FROM (SELECT DISTINCT symbol FROM bars)
UNION ALL SELECT 'ratios', '2004', symbol, '{"Error Message": "Limit Reach"}' FROM (SELECT DISTINCT symbol FROM bars)
UNION ALL SELECT 'ratios', '2005', symbol, '[]' FROM (SELECT DISTINCT symbol FROM bars)""",
    ["raw_bars", "fund_in", "bars"])
cte("payload_cls", """
SELECT source, dt, symbol,
  CASE WHEN body IS NULL OR trim(body) IN ('', '[]', '{}') THEN 'empty'
       WHEN NOT json_valid(body) THEN 'error'
       WHEN source = 'prices' AND json_extract_string(body, '$.status') = 'error' THEN 'error'
       WHEN source = 'ratios' AND json_extract(body, '$."Error Message"') IS NOT NULL THEN 'error'
       ELSE 'ok' END AS outcome
FROM payload_keys""", ["payload_keys"])
cte("pre_landed", """
SELECT source, dt, symbol FROM payload_cls WHERE outcome = 'ok' AND dt < '1998'""", ["payload_cls"])
oracle("landing_error_split", "SELECT source, dt, symbol, outcome FROM payload_cls", "payload_cls")
oracle("landing_new_only", f"""
SELECT 'prices' AS source, dt, symbol, CAST(1 AS BIGINT) AS n_payloads, CAST(count(*) AS BIGINT) AS n_values,
       {R('sum(coalesce(TRY_CAST("close" AS DOUBLE), 0))', 'body_sum')}, CAST(count(*) FILTER (WHERE volume IS NULL) AS BIGINT) AS n_no_volume
FROM raw_bars GROUP BY dt, symbol
UNION ALL
SELECT 'ratios', strftime(report_date, '%Y'), symbol, 1, count(*), {R('sum(debt_to_equity)', 'body_sum')}, 0
FROM fund_in GROUP BY 2, 3""", "raw_bars", "fund_in")
DRIFT_MONTH = "substr(dt, 6, 2)"
oracle("scan_json_drift", f"SELECT {PX} FROM flat WHERE {DRIFT_MONTH} <> '03'", "flat")
oracle("scan_json_quarantine", f"""
SELECT DISTINCT dt, symbol, 'broken' AS reason, '' AS field, CAST(NULL AS VARCHAR) AS value, CAST(1 AS BIGINT) AS n
FROM raw_bars WHERE {DRIFT_MONTH} = '03'
UNION ALL SELECT DISTINCT dt, symbol, 'undeclared', 'venue', '{{"mic":"X"}}', 1 FROM raw_bars WHERE {DRIFT_MONTH} = '04'
UNION ALL SELECT DISTINCT dt, symbol, 'undeclared', 'meta.zone', 'UTC', 1 FROM raw_bars WHERE {DRIFT_MONTH} = '05'
UNION ALL SELECT dt, symbol, 'undeclared', 'values[].trades', '7', count(*) FROM raw_bars WHERE {DRIFT_MONTH} = '06' GROUP BY 1, 2""",
       "raw_bars")
oracle("landing_summary", """
SELECT c.source,
       CASE WHEN l.symbol IS NOT NULL THEN 'skipped' WHEN c.outcome <> 'ok' THEN 'failed' ELSE 'fetched' END
         AS outcome,
       count(*) AS n
FROM payload_cls c LEFT JOIN pre_landed l ON c.source = l.source AND c.dt = l.dt AND c.symbol = l.symbol
GROUP BY 1, 2""", "payload_cls", "pre_landed")

# ------------------------------------------------------------------ SCD2
HIST = f"symbol, report_date, {rcols(['pe_ratio', 'debt_to_equity'])}, effective_date, source_api, " \
       "is_current, expiration_date"
KEYJ = "o.symbol = n.symbol AND o.report_date = n.report_date"
cte("chg_safe", f"""
SELECT o.* FROM fund_old o JOIN fund_in n ON {KEYJ}
WHERE o.pe_ratio IS DISTINCT FROM n.pe_ratio OR o.debt_to_equity IS DISTINCT FROM n.debt_to_equity""",
    ["fund_old", "fund_in"])
cte("chg_unsafe", f"""
SELECT o.* FROM fund_old o JOIN fund_in n ON {KEYJ}
WHERE o.pe_ratio <> n.pe_ratio OR o.debt_to_equity <> n.debt_to_equity""", ["fund_old", "fund_in"])
cte("merged", f"""
SELECT symbol, report_date, pe_ratio, debt_to_equity, effective_date, source_api,
       FALSE AS is_current, DATE '2002-02-01' AS expiration_date FROM chg_safe
UNION ALL
SELECT o.* EXCLUDE (ingestion_ts) FROM fund_old o
WHERE NOT EXISTS (SELECT 1 FROM chg_safe c WHERE c.symbol = o.symbol AND c.report_date = o.report_date)
UNION ALL
SELECT n.* EXCLUDE (ingestion_ts) FROM fund n
WHERE EXISTS (SELECT 1 FROM chg_safe c WHERE c.symbol = n.symbol AND c.report_date = n.report_date)
   OR NOT EXISTS (SELECT 1 FROM fund_old o WHERE {KEYJ})""", ["chg_safe", "fund_old", "fund"])
cte("merged_ref", """
SELECT o.* EXCLUDE (ingestion_ts) FROM fund_old o
WHERE NOT EXISTS (SELECT 1 FROM chg_unsafe c WHERE c.symbol = o.symbol AND c.report_date = o.report_date
                  AND c.effective_date = o.effective_date)
UNION ALL
SELECT symbol, report_date, pe_ratio, debt_to_equity, effective_date, source_api,
       FALSE, DATE '2002-02-01' FROM chg_unsafe
UNION ALL SELECT * EXCLUDE (ingestion_ts) FROM fund""", ["fund_old", "chg_unsafe", "fund"])

oracle("scd2_init", f"SELECT {HIST} FROM fund", "fund")
oracle("scd2_schema_upgrade", f"SELECT {HIST} FROM fund_old", "fund_old")
CHG = f"symbol, report_date, {rcols(['pe_ratio', 'debt_to_equity'])}, effective_date"
oracle("scd2_changes", f"SELECT {CHG} FROM chg_safe", "chg_safe")
oracle("scd2_changes_nullunsafe", f"SELECT {CHG} FROM chg_unsafe", "chg_unsafe")
oracle("scd2_new_keys", f"""
SELECT symbol, report_date, {rcols(['pe_ratio', 'debt_to_equity'])} FROM fund_in n
WHERE NOT EXISTS (SELECT 1 FROM fund_old o WHERE {KEYJ})""", "fund_in", "fund_old")
oracle("scd2_unchanged", f"""
SELECT {HIST} FROM fund_old o
WHERE NOT EXISTS (SELECT 1 FROM chg_unsafe c WHERE c.symbol = o.symbol AND c.report_date = o.report_date
                  AND c.effective_date = o.effective_date)""", "fund_old", "chg_unsafe")
oracle("scd2_expired", f"SELECT {HIST} FROM merged WHERE NOT is_current", "merged")
oracle("scd2_merge", f"SELECT {HIST} FROM merged", "merged")
oracle("sink_self_overwrite", f"SELECT {HIST} FROM merged", "merged")
oracle("history_parts", """
SELECT is_current, CAST(year(report_date) AS BIGINT) AS period, CAST(count(*) AS BIGINT) AS n_rows FROM merged GROUP BY 1, 2""", "merged")
oracle("scd2_merge_reference", f"SELECT {HIST} FROM merged_ref", "merged_ref")
oracle("scd2_metrics", """
SELECT count(*) AS total_rows, count(*) FILTER (WHERE is_current) AS current_rows,
       count(*) FILTER (WHERE NOT is_current) AS expired_rows FROM merged""", "merged")
oracle("scd2_change_counts", f"""
SELECT (SELECT count(*) FROM fund_in) AS incoming_rows,
       (SELECT count(*) FROM fund_old o JOIN fund_in n ON {KEYJ}) AS matched_rows,
       (SELECT count(*) FROM chg_safe) AS changed_null_safe,
       (SELECT count(*) FROM chg_unsafe) AS changed_null_unsafe,
       (SELECT count(*) FROM fund_in n WHERE NOT EXISTS (SELECT 1 FROM fund_old o WHERE {KEYJ})) AS new_keys""",
       "fund_in", "fund_old", "chg_safe", "chg_unsafe")
oracle("fund_current", f"SELECT {HIST} FROM merged WHERE is_current", "merged")
oracle("scd2_as_of", f"""
SELECT d AS as_of, {HIST} FROM merged, (VALUES (DATE '2001-06-30'), (DATE '2002-06-30')) v(d)
WHERE effective_date <= d AND (expiration_date IS NULL OR expiration_date > d)""", "merged")

# ------------------------------------------------------------------ scoring / serving
REC = f"""symbol, trade_date, {rcols(['close', 'prediction'])},
  CASE WHEN prediction > 0 THEN 'BUY' ELSE 'HOLD' END AS recommendation, {R('prediction * 100', 'prediction_pct')}"""
cte("latest", """
SELECT * FROM (SELECT *, ("close" - "open") / "close" AS prediction FROM lbars)
WHERE trade_date = (SELECT max(trade_date) FROM lbars) AND prediction IS NOT NULL""", ["lbars"])
oracle("recommendation", f"SELECT {REC} FROM pred_all", "pred_all")
oracle("latest_rows", f"SELECT symbol, trade_date, {rcols(['close', 'prediction'])} FROM latest", "latest")
ORACLE["latest_rows_stored"] = ORACLE["latest_rows"]
oracle("serving_future", f"SELECT {REC} FROM latest", "latest")
oracle("top_buys", f"""
SELECT symbol, {R('"close"', '"close"')}, {R('prediction * 100', 'prediction_pct')}, 'BUY' AS recommendation
FROM latest WHERE prediction > 0 ORDER BY prediction DESC, symbol LIMIT 5""", "latest")
SERV_BT = ["symbol", "trade_date", "close", "target_return_next_day", "prediction", "strategy_signal",
           "strategy_return", "market_return", "cum_strategy_return", "cum_market_return",
           "strategy_wealth", "market_wealth", "drawdown"]
oracle("serving_backtest", f"SELECT {_cols(SERV_BT, {'strategy_signal'})} FROM bt", "bt")
oracle("serving_registered", f"SELECT {_cols(SERV_BT, {'strategy_signal'})} FROM bt", "bt")
oracle("serving_metrics", metrics_sql([
    "symbol", "total_strategy_return", "total_market_return", "alpha", "num_trading_days", "num_days_invested",
    "avg_daily_strategy_return", "avg_daily_market_return", "stddev_strategy_return", "stddev_market_return",
    "sharpe_ratio", "sharpe_ratio_market", "max_drawdown", "model_precision_pct"]), "metrics")

# ------------------------------------------------------------------ model (S parts)

cte("ready", f"""
SELECT * FROM gold WHERE {' AND '.join(f'{c} IS NOT NULL' for c in [LABEL, *FEATURES])}""", ["gold"])
oracle("train_ready", f"SELECT symbol, trade_date, {_cols([LABEL, *FEATURES], {'volume'})} FROM ready", "ready")
oracle("time_split_counts", """
SELECT count(*) FILTER (WHERE trade_date < DATE '2000-01-01') AS train_rows,
       count(*) FILTER (WHERE trade_date >= DATE '2000-01-01') AS test_rows FROM ready""", "ready")
cte("ready_dates", """
SELECT trade_date, row_number() OVER (ORDER BY trade_date) - 1 AS i, count(*) OVER () AS n
FROM (SELECT DISTINCT trade_date FROM ready)""", ["ready"])
cte("fold_rows", """
SELECT k AS fold, r.trade_date, CASE WHEN d.i < n * k // 5 - 2 THEN 'train' WHEN d.i >= n * k // 5 AND d.i < n * (k + 1) // 5 THEN 'test' END AS part
FROM ready r JOIN ready_dates d ON r.trade_date = d.trade_date, (VALUES (1), (2), (3), (4)) v(k)""", ["ready", "ready_dates"])
oracle("walk_forward_folds", """
SELECT CAST(fold AS BIGINT) AS fold, count(*) FILTER (WHERE part = 'train') AS train_rows, count(*) FILTER (WHERE part = 'test') AS test_rows,
       max(trade_date) FILTER (WHERE part = 'train') AS last_train, min(trade_date) FILTER (WHERE part = 'test') AS first_test,
       max(trade_date) FILTER (WHERE part = 'test') AS last_test
FROM fold_rows GROUP BY fold""", "fold_rows")
_Z = ", ".join(R(f"CASE WHEN stddev_samp({f}) OVER () = 0 THEN 0.0 "
                 f"ELSE ({f} - avg({f}) OVER ()) / stddev_samp({f}) OVER () END", f"{f}_z") for f in FEATURES)
oracle("standardize", f"SELECT symbol, trade_date, {_Z} FROM ready", "ready")
oracle("rmse", f"SELECT {R('sqrt(avg(power(prediction - target_return_next_day, 2)))', 'rmse')} FROM pred_all", "pred_all")

oracle("ml_cv_report", """
SELECT CAST(d AS BIGINT) AS max_depth, CAST(i AS BIGINT) AS max_iter, TRUE AS plausible, CAST(1 AS BIGINT) AS n_best
FROM (VALUES (5), (8)) a(d), (VALUES (20), (40)) b(i)""")
oracle("ml_scored", f"""
SELECT symbol, trade_date, {R(LABEL, LABEL)}, TRUE AS is_scored FROM ready WHERE trade_date >= DATE '2000-01-01'""", "ready")
oracle("future_scored", f"""
SELECT symbol, trade_date, {R('"close"', '"close"')}, TRUE AS follows
FROM gold WHERE trade_date = (SELECT max(trade_date) FROM gold)""", "gold")
