"""Adapters from the driver's TPC-H-style tables to price/fundamental data.

Fixed definitions (the same rules are written as SQL in ``plans/oracle.py``):

``bars``      lineitem x part; symbol = p_brand, trade_date = date(l_shipdate),
              price = p_retailprice; order inside a day = (l_orderkey,
              l_linenumber, l_partkey); open = first, close = last, high =
              max, low = min, volume = bigint(sum(l_quantity))
``fund``      per (p_brand, quarter of l_shipdate): report_date = quarter
              start + 3 months; pe_ratio = double(sum(bigint(l_quantity))) /
              count(*); debt_to_equity = max(l_extendedprice) /
              min(l_extendedprice); effective 2002-02-01, all current
``fund_old``  fund with report_date < 2000-01-01; pe_ratio + 1 when the
              report month is 4; debt_to_equity null when it is 7;
              effective 2000-01-01, all current
``pred_all``  bars with the next-day label, rows without label dropped;
              prediction = (close - open) / close
``pred``      pred_all with trade_date >= 2000-01-01 (the backtest's period)
``raw_bars``  bars as text, broken by day of month: 5 close 'n/a'; 9 close
              '-1'; 11 volume null; 17 date 'bad'; 19 open = high + 1;
              23 low = close + 1
``raw_docs``  raw_bars as one price document per (month, symbol)
``ratio_docs``  fund rows as one JSON array per (year, symbol)
``payloads``  (source, dt, symbol, body) landing payloads from the two
              document sets plus one error payload per symbol and source and
              one empty payload per symbol
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPLIT_DATE = "2000-01-01"
FUND_EFFECTIVE = "2002-02-01"
FUND_OLD_EFFECTIVE = "2000-01-01"
FIXED_TS = _dt.datetime(2002, 2, 1, 6, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lineitem_part(spark: SparkSession, sf_dir: str, extra: list[str] = ()) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate", *extra)
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    return li.join(part, F.col("l_partkey") == F.col("p_partkey"))


def _line_sequence():
    """(l_orderkey, l_linenumber, l_partkey) as one decimal(38,0) with the same
    order: orderkey * 10^14 + linenumber * 10^13 + partkey (linenumber < 10,
    partkey < 10^13). A decimal ordering key keeps min_by/max_by in a hash
    aggregate (a struct key would force a sort-based aggregate)."""
    d = lambda c: F.col(c).cast("decimal(38,0)")
    return (d("l_orderkey") * F.lit(10 ** 14).cast("decimal(38,0)")
            + d("l_linenumber") * F.lit(10 ** 13).cast("decimal(38,0)") + d("l_partkey"))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV bars per brand (unique on symbol, trade_date)."""
    j = _lineitem_part(spark, sf_dir)
    seq = _line_sequence()
    return j.groupBy(
        F.col("p_brand").alias("symbol"), F.to_date("l_shipdate").alias("trade_date"),
    ).agg(
        F.min_by("p_retailprice", seq).alias("open"),
        F.max("p_retailprice").alias("high"),
        F.min("p_retailprice").alias("low"),
        F.max_by("p_retailprice", seq).alias("close"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
    )


def fund_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised incoming fundamentals (no SCD2 columns yet)."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    j = li.join(part, F.col("l_partkey") == F.col("p_partkey"))
    q = F.to_date(F.date_trunc("quarter", F.col("l_shipdate")))
    return j.groupBy(F.col("p_brand").alias("symbol"), F.add_months(q, 3).alias("report_date")).agg(
        (F.sum(F.col("l_quantity").cast("bigint")).cast("double") / F.count(F.lit(1))).alias("pe_ratio"),
        (F.max("l_extendedprice") / F.min("l_extendedprice")).alias("debt_to_equity"),
    ).withColumns({
        "effective_date": F.lit(FUND_EFFECTIVE).cast("date"),
        "source_api": F.lit("fmp"),
        "ingestion_ts": F.lit(FIXED_TS),
    })


def fund(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fundamentals history with every report current."""
    return fund_incoming(spark, sf_dir).withColumns({
        "is_current": F.lit(True),
        "expiration_date": F.lit(None).cast("date"),
    })


def fund_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.month("report_date")
    return fund(spark, sf_dir).filter(F.col("report_date") < F.lit(SPLIT_DATE).cast("date")).withColumns({
        "pe_ratio": F.when(m == 4, F.col("pe_ratio") + 1).otherwise(F.col("pe_ratio")),
        "debt_to_equity": F.when(m == 7, F.lit(None).cast("double")).otherwise(F.col("debt_to_equity")),
        "effective_date": F.lit(FUND_OLD_EFFECTIVE).cast("date"),
        "ingestion_ts": F.lit(_dt.datetime(2000, 1, 1, 6, 0, 0)),
    })


def labelled_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sparkfolio.operators.features import next_day_return_expr
    from sparkfolio.schemas import LABEL
    return bars(spark, sf_dir).withColumn(LABEL, next_day_return_expr())


def pred_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with a fixed prediction: (close - open) / close."""
    from sparkfolio.schemas import LABEL
    return labelled_bars(spark, sf_dir).filter(F.col(LABEL).isNotNull()) \
        .withColumn("prediction", F.try_divide(F.col("close") - F.col("open"), F.col("close")))


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test period of :func:`pred_all`, which a backtest runs over."""
    return pred_all(spark, sf_dir).filter(F.col("trade_date") >= F.lit(SPLIT_DATE).cast("date"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All bars with the fixed prediction; the latest date of a symbol has no label."""
    return labelled_bars(spark, sf_dir).withColumn(
        "prediction", F.try_divide(F.col("close") - F.col("open"), F.col("close")))


def raw_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String-typed bars with broken values on six days of each month."""
    b = bars(spark, sf_dir)
    day = F.dayofmonth("trade_date")
    s = lambda c: F.col(c).cast("string")
    return b.select(
        F.date_format("trade_date", "yyyy-MM").alias("dt"),
        F.col("symbol"),
        F.when(day == 17, F.lit("bad")).otherwise(F.date_format("trade_date", "yyyy-MM-dd")).alias("datetime"),
        F.when(day == 19, (F.col("high") + 1).cast("string")).otherwise(s("open")).alias("open"),
        s("high").alias("high"),
        F.when(day == 23, (F.col("close") + 1).cast("string")).otherwise(s("low")).alias("low"),
        F.when(day == 5, F.lit("n/a")).when(day == 9, F.lit("-1")).otherwise(s("close")).alias("close"),
        F.when(day == 11, F.lit(None).cast("string")).otherwise(s("volume")).alias("volume"),
    )


def raw_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested price document per (month, symbol): (dt, symbol, meta, values)."""
    return raw_bars(spark, sf_dir).groupBy("dt", "symbol").agg(
        F.struct(F.col("symbol"), F.lit("1day").alias("interval")).alias("meta"),
        F.collect_list(F.struct("datetime", "open", "high", "low", "close", "volume")).alias("values"),
    )


def ratio_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON array of ratio objects per (year, symbol): (dt, symbol, body)."""
    f = fund_incoming(spark, sf_dir)
    obj = F.struct(
        F.col("symbol"),
        F.date_format("report_date", "yyyy-MM-dd").alias("date"),
        F.col("pe_ratio").alias("priceToEarningsRatio"),
        F.col("debt_to_equity").alias("debtToEquityRatio"),
    )
    return f.groupBy(F.date_format("report_date", "yyyy").alias("dt"), "symbol").agg(
        F.to_json(F.collect_list(obj)).alias("body"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, dt, symbol, body) for the landing zone, errors included."""
    docs = raw_docs(spark, sf_dir).select(
        F.lit("prices").alias("source"), "dt", "symbol",
        F.to_json(F.struct("meta", "values")).alias("body"))
    ratios = ratio_docs(spark, sf_dir).select(F.lit("ratios").alias("source"), "dt", "symbol", "body")
    # fixed failure payloads, one of each per symbol
    kinds = [
        ("prices", "2002-12", '{"status": "error", "message": "rate limit"}'),
        ("ratios", "2004", '{"Error Message": "Limit Reach"}'),
        ("ratios", "2005", "[]"),
    ]
    kind = F.explode(F.array(*[
        F.struct(F.lit(src).alias("source"), F.lit(dt).alias("dt"), F.lit(body).alias("body"))
        for src, dt, body in kinds]))
    errors = bars(spark, sf_dir).select("symbol").distinct() \
        .select("symbol", kind.alias("k")).select("k.source", "k.dt", "symbol", "k.body")
    return docs.unionByName(ratios).unionByName(errors)

