"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, each over the whole driver tables.

Outputs are rounded to 6 places for doubles and use bigint for integers so
they compare with the DuckDB oracle (``plans/oracle_queries.py``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfolio.functions.columns import ints_to_long, round_doubles
from sparkfolio.operators import asof
from sparkfolio.operators import backtest as bt
from sparkfolio.operators import features as ft
from sparkfolio.operators import indicators as ind
from sparkfolio.operators import metrics as mt
from sparkfolio.operators import model as md
from sparkfolio.operators import quality as qa
from sparkfolio.operators import scd2
from sparkfolio.operators import scoring as sc
from sparkfolio.plans import fixtures as fx
from sparkfolio.schemas import BACKTEST_COLUMNS, FEATURES, LABEL, RAW_PRICES, RAW_RATIOS
from sparkfolio.session import checkpoint, scratch_path, unique_name
from sparkfolio.sources import history as hs
from sparkfolio.sources import landing as ld
from sparkfolio.sources import readers as rd
from sparkfolio.sources import writers as wr

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# chunk size used by the *_chunked queries: small enough that every series of
# the test data spans several chunks, so halos and prefixes are exercised.
TEST_CHUNK_ROWS = 256


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def out(df: DataFrame, *cols: str) -> DataFrame:
    """Final projection for comparison: chosen columns, bigint ints, 6-dp doubles."""
    if cols:
        df = df.select(*cols)
    return round_doubles(ints_to_long(df))


# ------------------------------------------------------------------ windows / indicators
@query("rolling_mean")
def q_rolling_mean(spark, sf):
    w = ind.series_window()
    b = fx.bars(spark, sf)
    return out(b.withColumns({
        "mean_12": ind.rolling_mean("close", 12, w),
        "mean_20": ind.rolling_mean("close", 20, w),
        "mean_26": ind.rolling_mean("close", 26, w),
    }), "symbol", "trade_date", "mean_12", "mean_20", "mean_26")


@query("rolling_stddev")
def q_rolling_stddev(spark, sf):
    w = ind.series_window()
    b = ft.log_return(fx.bars(spark, sf))
    return out(b.withColumns({
        "stddev_20": ind.rolling_stddev("close", 20, w),
        "stddev_ret_10": ind.rolling_stddev("daily_return", 10, w),
    }), "symbol", "trade_date", "stddev_20", "stddev_ret_10")


@query("log_return")
def q_log_return(spark, sf):
    return out(ft.log_return(fx.bars(spark, sf)), "symbol", "trade_date", "close", "daily_return")


@query("return_lags")
def q_return_lags(spark, sf):
    b = ft.return_lags(ft.log_return(fx.bars(spark, sf)))
    return out(b, "symbol", "trade_date", "daily_return", "return_lag_1", "return_lag_2", "return_lag_3")


@query("volatility")
def q_volatility(spark, sf):
    b = ft.volatility(ft.log_return(fx.bars(spark, sf)))
    return out(b, "symbol", "trade_date", "volatility_10d")


@query("next_day_return")
def q_next_day_return(spark, sf):
    b = fx.bars(spark, sf).withColumn(LABEL, ft.next_day_return_expr())
    return out(b, "symbol", "trade_date", "close", LABEL)


@query("bollinger")
def q_bollinger(spark, sf):
    return out(ind.bollinger(fx.bars(spark, sf)),
               "symbol", "trade_date", "close", "sma_20", "bollinger_upper", "bollinger_lower")


@query("macd")
def q_macd(spark, sf):
    return out(ind.macd(fx.bars(spark, sf)), "symbol", "trade_date", "ema_12", "ema_26", "macd_line", "sma_diff")


@query("rsi")
def q_rsi(spark, sf):
    return out(ind.rsi(fx.bars(spark, sf)), "symbol", "trade_date", "close", "rsi_14")


@query("pct_b")
def q_pct_b(spark, sf):
    b = ind.bollinger(fx.bars(spark, sf)).withColumn("pct_b", ft.pct_b_expr())
    return out(b, "symbol", "trade_date", "pct_b")


# ------------------------------------------------------------------ as-of join / features
ASOF_COLS = ("symbol", "trade_date", "open", "high", "low", "close", "volume", "pe_ratio", "debt_to_equity")


@query("asof_join")
def q_asof_join(spark, sf):
    fund = fx.fund(spark, sf).filter(F.col("is_current"))
    return out(asof.asof_join(fx.bars(spark, sf), fund), *ASOF_COLS)


@query("asof_join_union")
def q_asof_join_union(spark, sf):
    fund = fx.fund(spark, sf).filter(F.col("is_current"))
    return out(asof.asof_join_union(fx.bars(spark, sf), fund), *ASOF_COLS)


@query("asof_join_shuffle")
def q_asof_join_shuffle(spark, sf):
    """The as-of join with broadcasting disabled: shuffle on (symbol, year)."""
    fund = fx.fund(spark, sf).filter(F.col("is_current"))
    return out(asof.asof_join(fx.bars(spark, sf), fund, shuffle=True), *ASOF_COLS)


@query("first_per_group")
def q_first_per_group(spark, sf):
    f = fx.fund(spark, sf).select("symbol", "report_date", "pe_ratio", "debt_to_equity")
    return out(asof.first_per_group(f, ["symbol"], [F.col("report_date").desc()]))


@query("gold_features")
def q_gold_features(spark, sf):
    return out(ft.gold_features(fx.bars(spark, sf), fx.fund(spark, sf)))


@query("gold_features_chunked")
def q_gold_features_chunked(spark, sf):
    return out(ft.gold_features(fx.bars(spark, sf), fx.fund(spark, sf), chunk_rows=TEST_CHUNK_ROWS))


# ------------------------------------------------------------------ backtest / metrics
def _backtest(spark, sf, chunk_rows=None, rank_buckets=None) -> DataFrame:
    return bt.backtest(fx.pred(spark, sf), chunk_rows=chunk_rows, rank_buckets=rank_buckets)


@query("signal_strategy")
def q_signal_strategy(spark, sf):
    return out(bt.signal_strategy(fx.pred_all(spark, sf)), "symbol", "trade_date", "prediction", "strategy_signal")


@query("daily_rank")
def q_daily_rank(spark, sf):
    return out(bt.daily_rank(fx.pred_all(spark, sf)),
               "symbol", "trade_date", "prediction", "prediction_rank", "strategy_signal_rank")


@query("daily_rank_split")
def q_daily_rank_split(spark, sf):
    """daily_rank with every date split into 4 value ranges (exact ranks)."""
    return out(bt.daily_rank(fx.pred_all(spark, sf), split_buckets=4),
               "symbol", "trade_date", "prediction", "prediction_rank", "strategy_signal_rank")


@query("strategy_returns")
def q_strategy_returns(spark, sf):
    return out(_backtest(spark, sf), "symbol", "trade_date", "strategy_return", "strategy_return_rank",
               "market_return")


@query("cumulative_return")
def q_cumulative_return(spark, sf):
    return out(_backtest(spark, sf), "symbol", "trade_date", "cum_strategy_return",
               "cum_strategy_return_rank", "cum_market_return")


@query("wealth")
def q_wealth(spark, sf):
    return out(_backtest(spark, sf), "symbol", "trade_date", "strategy_wealth", "strategy_wealth_rank",
               "market_wealth")


@query("drawdown")
def q_drawdown(spark, sf):
    return out(_backtest(spark, sf), "symbol", "trade_date", "drawdown", "drawdown_rank")


@query("backtest")
def q_backtest(spark, sf):
    return out(_backtest(spark, sf), *BACKTEST_COLUMNS)


@query("backtest_chunked")
def q_backtest_chunked(spark, sf):
    """backtest with long series chunked and daily cross-sections split."""
    return out(_backtest(spark, sf, TEST_CHUNK_ROWS, rank_buckets=4), *BACKTEST_COLUMNS)


def _metrics(spark, sf, keep_counts=False) -> DataFrame:
    return mt.backtest_metrics(_backtest(spark, sf), keep_counts=keep_counts)


@query("backtest_metrics")
def q_backtest_metrics(spark, sf):
    return out(_metrics(spark, sf))


@query("precision_counts")
def q_precision_counts(spark, sf):
    return out(_metrics(spark, sf, keep_counts=True), "symbol", "true_positives", "total_positive_predictions")


@query("precision")
def q_precision(spark, sf):
    return out(_metrics(spark, sf), "symbol", "model_precision_pct")


@query("sharpe")
def q_sharpe(spark, sf):
    return out(_metrics(spark, sf), "symbol", "sharpe_ratio", "sharpe_ratio_rank", "sharpe_ratio_market")


@query("summary_signal")
def q_summary_signal(spark, sf):
    return out(mt.summary_signal(_metrics(spark, sf)))


@query("summary_ranking")
def q_summary_ranking(spark, sf):
    return out(mt.summary_ranking(_metrics(spark, sf)))


# ------------------------------------------------------------------ quality / flatten

PRICE_COLS = ("symbol", "trade_date", "open", "high", "low", "close", "volume")
RUN_DATE = fx.FUND_EFFECTIVE


def _flat(spark, sf) -> DataFrame:
    return qa.flatten_prices(fx.raw_docs(spark, sf))


@query("price_flatten")
def q_price_flatten(spark, sf):
    df = qa.with_lineage(_flat(spark, sf), "twelvedata", ingestion_date=RUN_DATE)
    return out(df, *PRICE_COLS, "source_api", "ingestion_date")


@query("dq_validate")
def q_dq_validate(spark, sf):
    return out(qa.add_validity(_flat(spark, sf)), *PRICE_COLS, "is_valid")


@query("dq_counts")
def q_dq_counts(spark, sf):
    return out(qa.validity_counts(_flat(spark, sf)))


@query("dq_invalid_sample")
def q_dq_invalid_sample(spark, sf):
    return out(qa.invalid_sample(_flat(spark, sf), 10))


@query("silver_prices")
def q_silver_prices(spark, sf):
    valid, _ = qa.split_valid(_flat(spark, sf))
    return out(qa.with_lineage(valid, "twelvedata", ingestion_date=RUN_DATE),
               *PRICE_COLS, "source_api", "ingestion_date")


@query("null_report")
def q_null_report(spark, sf):
    return out(qa.null_report(_flat(spark, sf), ["trade_date", "open", "high", "low", "close", "volume"]))


@query("drop_missing")
def q_drop_missing(spark, sf):
    return out(qa.drop_missing(_flat(spark, sf), ["trade_date", "close", "volume"]))


@query("fill_missing")
def q_fill_missing(spark, sf):
    return out(qa.fill_missing(_flat(spark, sf), ["open", "close", "volume"]))


@query("empty_like")
def q_empty_like(spark, sf):
    """A first batch appended to an empty table of the same schema."""
    bars = fx.bars(spark, sf)
    return out(rd.empty_like(bars).unionByName(bars))


@query("row_counts")
def q_row_counts(spark, sf):
    """Row counts of four tables in one aggregation over their tagged union."""
    parts = {"bars_rows": fx.bars(spark, sf), "fund_rows": fx.fund(spark, sf),
             "pred_rows": fx.pred(spark, sf), "raw_price_rows": _flat(spark, sf)}
    tagged = None
    for name, df in parts.items():
        t = df.select(F.lit(name).alias("_t"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return out(tagged.agg(*[F.count_if(F.col("_t") == n).alias(n) for n in parts]))


# ------------------------------------------------------------------ scans and sinks
def _write_raw_docs(spark, sf) -> str:
    """Price documents as JSON lines under source=prices/dt=<month>/ (one
    line per symbol document; the symbol is inside the document)."""
    root = scratch_path(spark, "landing")
    docs = fx.raw_docs(spark, sf).select(
        F.lit("prices").alias("source"), "dt",
        F.to_json(F.struct("meta", "values")).alias("value"))
    docs.write.mode("append").partitionBy("source", "dt").text(root)
    return root


@query("scan_json_nested")
def q_scan_json_nested(spark, sf):
    root = _write_raw_docs(spark, sf)
    return out(qa.flatten_prices(rd.read_json(spark, root, RAW_PRICES)), *PRICE_COLS)


@query("scan_partition_pruned")
def q_scan_partition_pruned(spark, sf):
    root = _write_raw_docs(spark, sf)
    raw = rd.read_json(spark, root, RAW_PRICES, where=(F.col("dt") >= "1998-01") & (F.col("dt") <= "1998-12"))
    return out(qa.flatten_prices(raw), *PRICE_COLS)


def _write_ratio_docs(spark, sf, drop: tuple[str, ...] = ()) -> str:
    root = scratch_path(spark, "ratios")
    f = fx.fund_incoming(spark, sf)
    fields = {
        "symbol": F.col("symbol"),
        "date": F.date_format("report_date", "yyyy-MM-dd"),
        "priceToEarningsRatio": F.col("pe_ratio"),
        "debtToEquityRatio": F.col("debt_to_equity"),
    }
    obj = F.struct(*[c.alias(n) for n, c in fields.items() if n not in drop])
    (f.groupBy(F.date_format("report_date", "yyyy").alias("dt"), "symbol")
      .agg(F.to_json(F.collect_list(obj)).alias("value"))
      .select("value", F.lit("ratios").alias("source"), "dt", "symbol")
      .write.mode("append").partitionBy("source", "dt", "symbol").text(root))
    return root


@query("scan_json_array")
def q_scan_json_array(spark, sf):
    raw = rd.read_json(spark, _write_ratio_docs(spark, sf))
    return out(raw, "symbol", "date", "priceToEarningsRatio", "debtToEquityRatio")


@query("fund_standardize")
def q_fund_standardize(spark, sf):
    raw = rd.read_json(spark, _write_ratio_docs(spark, sf))
    std = scd2.standardize_fundamentals(raw, RUN_DATE)
    return out(std, "symbol", "report_date", "pe_ratio", "debt_to_equity", "effective_date", "source_api")


@query("ensure_columns")
def q_ensure_columns(spark, sf):
    raw = rd.read_json(spark, _write_ratio_docs(spark, sf, drop=("debtToEquityRatio",)))
    std = scd2.standardize_fundamentals(raw, RUN_DATE)
    return out(std, "symbol", "report_date", "pe_ratio", "debt_to_equity", "effective_date", "source_api")


@query("scan_parquet")
def q_scan_parquet(spark, sf):
    """Write bars partitioned by symbol (the gold layout), read back: the
    partition column is discovered from the paths."""
    path = scratch_path(spark, "gold_layout")
    wr.write_partitions(fx.bars(spark, sf), path, ["symbol"])
    return out(rd.read_table(spark, path))


@query("sink_dynamic_overwrite")
def q_sink_dynamic_overwrite(spark, sf):
    """Batch 1 = all bars; batch 2 = the 2001 bars again, re-sourced and
    without the first symbol: every 2001 date is replaced as a whole."""
    path = scratch_path(spark, "silver_prices")
    b = fx.bars(spark, sf).withColumn("source_api", F.lit("twelvedata"))
    wr.write_partitions(b, path, ["trade_date"])
    batch2 = b.filter((F.year("trade_date") == 2001) & (F.col("symbol") != b.select(F.min("symbol")).scalar())) \
        .withColumn("source_api", F.lit("rerun"))
    wr.write_partitions(batch2, path, ["trade_date"])
    return out(rd.read_table(spark, path), "symbol", "trade_date", "close", "source_api")


@query("sink_replace")
def q_sink_replace(spark, sf):
    path = scratch_path(spark, "metrics")
    wr.replace_table(fx.bars(spark, sf), path)
    wr.replace_table(fx.bars(spark, sf).filter(F.col("trade_date") >= F.lit(fx.SPLIT_DATE).cast("date")), path)
    return out(rd.read_table(spark, path), "symbol", "trade_date", "close", "volume")


@query("sink_self_overwrite")
def q_sink_self_overwrite(spark, sf):
    """Store a history, merge a batch into it (only the years that change are
    rewritten), read the next version by its catalog name."""
    root = scratch_path(spark, "fundamentals")
    name = unique_name("silver_fundamentals")
    hs.start(spark, root, fx.fund_old(spark, sf))
    hs.merge(spark, root, checkpoint(fx.fund_incoming(spark, sf)), fx.FUND_EFFECTIVE)
    hs.publish_view(spark, root, name)
    return out(spark.table(name), *[c for c in scd2.HISTORY_COLUMNS if c != "ingestion_ts"])


@query("history_parts")
def q_history_parts(spark, sf):
    """Rows of each part after a merge: current and closed rows by year of the report."""
    root = scratch_path(spark, "fundamentals")
    hs.start(spark, root, fx.fund_old(spark, sf))
    hs.merge(spark, root, checkpoint(fx.fund_incoming(spark, sf)), fx.FUND_EFFECTIVE)
    rows = spark.createDataFrame([(p.is_current, p.period, p.n_rows) for p in hs.parts(spark, root)], "is_current boolean, period long, n long")
    return out(rows.groupBy("is_current", "period").agg(F.sum("n").alias("n_rows")))


# ------------------------------------------------------------------ landing
def _pre_landed(spark, sf) -> str:
    root = scratch_path(spark, "bronze")
    first = fx.payloads(spark, sf).filter(F.col("dt") < "1998")
    ld.land_new(spark, first, root)
    return root


@query("landing_error_split")
def q_landing_error_split(spark, sf):
    return out(ld.classify_payloads(fx.payloads(spark, sf)), "source", "dt", "symbol", "outcome")


@query("landing_new_only")
def q_landing_new_only(spark, sf):
    """Payloads landed in two runs, with what their bodies hold."""
    root = _pre_landed(spark, sf)
    ld.land_new(spark, fx.payloads(spark, sf), root)
    landed = ld.read_landed(spark, root)
    prices = F.from_json("value", RAW_PRICES)["values"]
    ratios = F.from_json("value", T.ArrayType(RAW_RATIOS))
    is_price = F.col("source") == "prices"
    total = lambda values, get: F.aggregate(values, F.lit(0.0), lambda a, v: a + F.coalesce(get(v), F.lit(0.0)))
    return out(landed.groupBy("source", "dt", "symbol").agg(
        F.count(F.lit(1)).alias("n_payloads"),
        F.sum(F.when(is_price, F.size(prices)).otherwise(F.size(ratios))).alias("n_values"),
        F.sum(F.when(is_price, total(prices, lambda v: v["close"].try_cast("double")))
              .otherwise(total(ratios, lambda v: v["debtToEquityRatio"]))).alias("body_sum"),
        F.sum(F.when(is_price, F.size(F.filter(prices, lambda v: v["volume"].isNull()))).otherwise(0)).alias("n_no_volume")))


@query("landing_summary")
def q_landing_summary(spark, sf):
    root = _pre_landed(spark, sf)
    return out(ld.landing_summary(fx.payloads(spark, sf), ld.landed_keys(spark, root)))


def _drifted(spark, sf) -> DataFrame:
    """Landed price documents of which some are cut off and some hold fields that no schema declares."""
    root = scratch_path(spark, "bronze")
    docs = fx.raw_docs(spark, sf).withColumn("m", F.substring("dt", 6, 2))
    body = F.when(F.col("m") == "03", F.expr("substring(b, 1, length(b) - 2)")) \
        .when(F.col("m") == "04", F.concat(F.lit('{"venue":{"mic":"X"},'), F.expr("substring(b, 2)"))) \
        .when(F.col("m") == "05", F.expr("""replace(b, '"interval"', '"zone":"UTC","interval"')""")) \
        .when(F.col("m") == "06", F.expr("""replace(b, '"datetime"', '"trades":7,"datetime"')""")).otherwise(F.col("b"))
    docs.withColumn("b", F.to_json(F.struct("meta", "values"))).select("symbol", body.alias("value"), "dt") \
        .write.partitionBy("dt").parquet(root)
    return rd.parse_documents(rd.read_table(spark, root, "symbol string, value string, dt string"), RAW_PRICES, "value",
                              {"dt": "dt", "key_symbol": "symbol"})


@query("scan_json_drift")
def q_scan_json_drift(spark, sf):
    """The bars of drifted documents: undeclared fields change nothing, broken documents give no bars."""
    whole = _drifted(spark, sf).filter(F.col(rd.CORRUPT).isNull())
    return out(qa.flatten_prices(whole), *PRICE_COLS)


@query("scan_json_quarantine")
def q_scan_json_quarantine(spark, sf):
    """What was set aside of each document, by reason and field."""
    q = rd.quarantine(_drifted(spark, sf))
    field = F.regexp_replace("path", r"\[\d+\]", "[]").alias("field")
    value = F.when(F.col("reason") == "undeclared", F.col("value")).alias("value")
    return out(q.groupBy("dt", F.col("key_symbol").alias("symbol"), "reason", field, value).agg(F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------------ SCD2
HIST_COLS = [c for c in scd2.HISTORY_COLUMNS if c != "ingestion_ts"]


def _merged(spark, sf, **kw) -> DataFrame:
    return scd2.scd2_merge(fx.fund_old(spark, sf), fx.fund_incoming(spark, sf), fx.FUND_EFFECTIVE, **kw)


@query("scd2_init")
def q_scd2_init(spark, sf):
    return out(scd2.scd2_init(fx.fund_incoming(spark, sf)), *HIST_COLS)


@query("scd2_schema_upgrade")
def q_scd2_schema_upgrade(spark, sf):
    legacy = fx.fund_old(spark, sf).select("symbol", "report_date", "pe_ratio", "debt_to_equity", "effective_date")
    return out(scd2.upgrade_history(legacy), *HIST_COLS)


@query("scd2_changes")
def q_scd2_changes(spark, sf):
    ch = scd2.scd2_changes(scd2.current(fx.fund_old(spark, sf)), fx.fund_incoming(spark, sf), null_safe=True)
    return out(ch, "symbol", "report_date", "pe_ratio", "debt_to_equity", "effective_date")


@query("scd2_changes_nullunsafe")
def q_scd2_changes_nullunsafe(spark, sf):
    ch = scd2.scd2_changes(scd2.current(fx.fund_old(spark, sf)), fx.fund_incoming(spark, sf), null_safe=False)
    return out(ch, "symbol", "report_date", "pe_ratio", "debt_to_equity", "effective_date")


@query("scd2_new_keys")
def q_scd2_new_keys(spark, sf):
    nk = scd2.scd2_new_keys(fx.fund_incoming(spark, sf), scd2.current(fx.fund_old(spark, sf)))
    return out(nk, "symbol", "report_date", "pe_ratio", "debt_to_equity")


@query("scd2_unchanged")
def q_scd2_unchanged(spark, sf):
    hist = fx.fund_old(spark, sf)
    ch = scd2.scd2_changes(scd2.current(hist), fx.fund_incoming(spark, sf), null_safe=False)
    return out(scd2.scd2_unchanged(hist, ch), *HIST_COLS)


@query("scd2_expired")
def q_scd2_expired(spark, sf):
    return out(_merged(spark, sf).filter(~F.col("is_current")), *HIST_COLS)


@query("scd2_merge")
def q_scd2_merge(spark, sf):
    return out(_merged(spark, sf), *HIST_COLS)


@query("scd2_merge_reference")
def q_scd2_merge_reference(spark, sf):
    m = scd2.scd2_merge_reference(fx.fund_old(spark, sf), fx.fund_incoming(spark, sf), fx.FUND_EFFECTIVE)
    return out(m, *HIST_COLS)


@query("scd2_metrics")
def q_scd2_metrics(spark, sf):
    return out(scd2.scd2_metrics(_merged(spark, sf)))


@query("scd2_change_counts")
def q_scd2_change_counts(spark, sf):
    return out(scd2.change_counts(scd2.current(fx.fund_old(spark, sf)), fx.fund_incoming(spark, sf)))


@query("fund_current")
def q_fund_current(spark, sf):
    return out(scd2.current(_merged(spark, sf)), *HIST_COLS)


@query("scd2_as_of")
def q_scd2_as_of(spark, sf):
    m = _merged(spark, sf)
    views = [scd2.as_of(m, d).withColumn("as_of", F.lit(d).cast("date")) for d in ("2001-06-30", "2002-06-30")]
    return out(views[0].unionByName(views[1]), "as_of", *HIST_COLS)


# ------------------------------------------------------------------ scoring / serving
@query("recommendation")
def q_recommendation(spark, sf):
    return out(sc.recommendation(fx.pred_all(spark, sf)))


@query("latest_rows")
def q_latest_rows(spark, sf):
    return out(sc.latest_rows(fx.scored(spark, sf), require=["prediction"]),
               "symbol", "trade_date", "close", "prediction")


@query("latest_rows_stored")
def q_latest_rows_stored(spark, sf):
    """The latest date of a stored table from its files' footers."""
    path = scratch_path(spark, "scored")
    wr.write_partitions(fx.scored(spark, sf), path, ["symbol"])
    stored = rd.read_table(spark, path, text=("symbol",))
    return out(sc.latest_rows(stored, require=["prediction"], date=rd.stored_max(spark, path, "trade_date")),
               "symbol", "trade_date", "close", "prediction")


@query("top_buys")
def q_top_buys(spark, sf):
    recs = sc.recommendation(sc.latest_rows(fx.scored(spark, sf), require=["prediction"]))
    return out(sc.top_buys(recs, 5))


@query("serving_backtest")
def q_serving_backtest(spark, sf):
    from sparkfolio.schemas import SERVING_BACKTEST
    return out(wr.serve(_backtest(spark, sf), SERVING_BACKTEST))


@query("serving_metrics")
def q_serving_metrics(spark, sf):
    from sparkfolio.schemas import SERVING_METRICS
    return out(wr.serve(_metrics(spark, sf), SERVING_METRICS))


@query("serving_future")
def q_serving_future(spark, sf):
    from sparkfolio.schemas import SERVING_FUTURE
    recs = sc.recommendation(sc.latest_rows(fx.scored(spark, sf), require=["prediction"]))
    return out(wr.serve(recs, SERVING_FUTURE))


@query("serving_registered")
def q_serving_registered(spark, sf):
    from sparkfolio.schemas import SERVING_BACKTEST
    path = scratch_path(spark, "backtest_results")
    wr.write_partitions(_backtest(spark, sf), path, ["symbol"])
    return out(wr.register_external(spark, unique_name("backtest_results"), path, SERVING_BACKTEST))


# ------------------------------------------------------------------ model

def _ready(spark, sf) -> DataFrame:
    return md.train_ready(ft.gold_features(fx.bars(spark, sf), fx.fund(spark, sf)))


def _cv_model(spark, sf):
    """The library's own grid and folds on the training period."""
    train, _ = md.time_split(_ready(spark, sf), fx.SPLIT_DATE)
    return md.tune(train, md.DEFAULT_GRID, md.DEFAULT_FOLDS, parallelism=8)


@query("train_ready")
def q_train_ready(spark, sf):
    return out(_ready(spark, sf), "symbol", "trade_date", LABEL, *FEATURES)


@query("time_split_counts")
def q_time_split_counts(spark, sf):
    train, test = md.time_split(_ready(spark, sf), fx.SPLIT_DATE)
    tagged = train.select(F.lit(True).alias("_train")).unionByName(test.select(F.lit(False).alias("_train")))
    return out(tagged.agg(F.count_if(F.col("_train")).alias("train_rows"),
                          F.count_if(~F.col("_train")).alias("test_rows")))


@query("walk_forward_folds")
def q_walk_forward_folds(spark, sf):
    """Training and test rows of each fold in time order."""
    f = md.walk_forward_folds(_ready(spark, sf).select("symbol", "trade_date"), folds=4, gap=2)
    role = F.col("role")
    return out(f.groupBy("fold").agg(
        F.count_if(role == "train").alias("train_rows"), F.count_if(role == "test").alias("test_rows"),
        F.max(F.when(role == "train", F.col("trade_date"))).alias("last_train"),
        F.min(F.when(role == "test", F.col("trade_date"))).alias("first_test"),
        F.max(F.when(role == "test", F.col("trade_date"))).alias("last_test")))


@query("standardize")
def q_standardize(spark, sf):
    z = md.standardize(_ready(spark, sf))
    return out(z, "symbol", "trade_date", *[f"{f}_z" for f in FEATURES])


@query("rmse")
def q_rmse(spark, sf):
    return out(fx.pred_all(spark, sf).agg(md.rmse_expr().alias("rmse")))


# What a model predicts has no SQL; the queries below return all that SQL can tell of its rows: keys, labels, grid points,
# and whether what must hold of the predictions does.
@query("ml_cv_report")
def q_ml_cv_report(spark, sf):
    """Grid points, whether each error is below that of predicting nothing twice over, and how many points are best."""
    report = md.cv_report(spark, _cv_model(spark, sf))
    scale = _ready(spark, sf).agg(F.sqrt(F.avg(F.pow(F.col(LABEL), 2)))).first()[0]
    best = report.filter("is_best").count()
    return out(report.select("max_depth", "max_iter", ((F.col("avg_rmse") > 0) & (F.col("avg_rmse") < 2 * scale)).alias("plausible"),
                             F.lit(best).alias("n_best")))


@query("ml_scored")
def q_ml_scored(spark, sf):
    """Test rows after scoring: keys, label, and whether each has a finite prediction."""
    _, test = md.time_split(_ready(spark, sf), fx.SPLIT_DATE)
    scored = md.score(_cv_model(spark, sf), test)
    finite = F.col("prediction").isNotNull() & (F.abs("prediction") < float("inf"))
    return out(scored.withColumn("is_scored", finite), "symbol", "trade_date", LABEL, "is_scored")


@query("future_scored")
def q_future_scored(spark, sf):
    """Recommendations of the latest date: keys, close, and whether the advice follows from the prediction."""
    latest = sc.latest_rows(ft.gold_features(fx.bars(spark, sf), fx.fund(spark, sf)))
    recs = sc.recommendation(md.score(_cv_model(spark, sf), latest))
    buy = F.when(F.col("prediction") > 0, "BUY").otherwise("HOLD")
    follows = (F.col("recommendation") == buy) & (F.abs(F.col("prediction_pct") - 100 * F.col("prediction")) < 1e-9)
    return out(recs.withColumn("follows", follows), "symbol", "trade_date", "close", "follows")
