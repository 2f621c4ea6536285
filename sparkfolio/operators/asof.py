"""Point-in-time (as-of) join and first-row-per-group.

For every price row ``(symbol, trade_date)`` attach the values of the latest
report of that symbol with ``report_date <= trade_date`` (no look-ahead);
rows before the first report keep null values. The newest report's values
are taken as a whole: a null ratio in it is not replaced by an older value.

Spark-first design (no collect, no per-row Python):

1. Reports are reduced to one row per ``(symbol, report_date)`` (ties broken
   by latest ``effective_date`` then ``ingestion_ts``) and turned into
   validity intervals ``[report_date, next_report_date)`` with ``lead`` over
   the small report table.
2. Each interval is exploded into the calendar years it covers, so the join
   key is ``(symbol, year)``: a long or hot symbol is spread over many keys,
   and each price row compares against the few intervals of its year only
   (range residual), and matches at most one. The interval table is bounded
   by reports x years, independent of the number of price rows.
3. The last interval of a symbol is open. It is exploded up to the newest
   report's year, which is a scalar subquery: the join runs no job of its own
   and stays a plan. The interval table carries no hint; adaptive execution
   measures it and broadcasts it when it is small, else it is a shuffle join on
   ``(symbol, year)``, which AQE splits when skewed.

:func:`asof_join_union` is the alternative form (one stream of reports and
prices, running maximum of the latest report, evaluated per time bucket);
both give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each group by ``order``.

    Remaining columns are appended as final tie-breaks so the pick is
    deterministic. ``row_number() == 1`` is planned with a partial
    WindowGroupLimit before the shuffle, so many copies of one key are
    reduced map-side and never travel to one task.
    """
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in set(keys)]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def report_intervals(reports: DataFrame, by: str = "symbol", date: str = "report_date",
                     values: Sequence[str] = ("pe_ratio", "debt_to_equity"),
                     tie: Sequence[str] = ("effective_date", "ingestion_ts")) -> DataFrame:
    """One row per (by, date) with its validity end ``_valid_to`` (exclusive)."""
    tie = [c for c in tie if c in reports.columns]
    best = reports.groupBy(by, date).agg(
        F.max(F.struct(*[F.col(c) for c in tie], *[F.col(v) for v in values])).alias("_v"))
    w = Window.partitionBy(by).orderBy(date)
    return best.select(
        F.col(by), F.col(date),
        F.lead(date, 1).over(w).alias("_valid_to"),
        *[F.col(f"_v.{v}").alias(v) for v in values],
    )


def asof_join(left: DataFrame, right: DataFrame, by: str = "symbol",
              left_ts: str = "trade_date", right_ts: str = "report_date",
              values: Sequence[str] = ("pe_ratio", "debt_to_equity"),
              tie: Sequence[str] = ("effective_date", "ingestion_ts"),
              shuffle: bool = False) -> DataFrame:
    """Left rows + ``values`` of the latest right row with right_ts <= left_ts.

    Left rows are kept as they are (one output row per input row).

    Intervals are exploded over [year(start), year(end - 1 day)]; the last,
    open interval of a symbol up to the latest report year G. On the left
    side the join year is min(year(left_ts), G): rows after G look up the
    year-G intervals, where only the open ones (or ones ending later) pass the
    range residual. G is read from the reports inside the query.
    ``shuffle`` asks for the join on (by, year) whatever the sizes.
    """
    top = right.select(F.max(F.year(right_ts)).cast("int")).scalar()
    keyed = report_intervals(right, by, right_ts, values, tie).withColumn("_top", top).select(
        F.col(by).alias("_r_by"),
        F.col(right_ts).alias("_r_from"),
        F.col("_valid_to").alias("_r_to"),
        *[F.col(v).alias(f"_r_{v}") for v in values],
        F.explode(F.sequence(
            F.year(right_ts),
            F.coalesce(F.year(F.date_sub("_valid_to", 1)), F.col("_top")),
        )).alias("_r_year"),
    )
    if shuffle:
        keyed = keyed.hint("merge")
    lft = left.withColumn("_l_year", F.least(F.year(F.col(left_ts)), top))
    cond = (
        (F.col(by) == F.col("_r_by"))
        & (F.col("_l_year") == F.col("_r_year"))
        & (F.col("_r_from") <= F.col(left_ts))
        & (F.col("_r_to").isNull() | (F.col(left_ts) < F.col("_r_to")))
    )
    joined = lft.join(keyed, cond, "left")
    return joined.select(
        *[F.col(c) for c in left.columns],
        *[F.col(f"_r_{v}").alias(v) for v in values],
    )


def asof_join_union(left: DataFrame, right: DataFrame, by: str = "symbol",
                    left_ts: str = "trade_date", right_ts: str = "report_date",
                    values: Sequence[str] = ("pe_ratio", "debt_to_equity"),
                    tie: Sequence[str] = ("effective_date", "ingestion_ts"),
                    bucket_days: int = 366) -> DataFrame:
    """Same result as :func:`asof_join` without a join on ranges: reports and
    prices form one stream; each price row takes the latest report at or
    before it (a report sorts before prices of the same date).

    "Latest report so far" is a running maximum of (report date, values), so
    it is evaluated per (symbol, time bucket) and completed with the maximum
    of all earlier buckets (a small per-bucket table): no task holds a whole
    symbol.
    """
    iv = report_intervals(right, by, right_ts, values, tie)
    rep_t = iv.schema[right_ts].dataType
    rep = iv.select(
        F.col(by), F.col(right_ts).alias("_t"), F.lit(0).alias("_kind"),
        F.struct(F.col(right_ts).alias("_at"), *[F.col(v) for v in values]).alias("_rep"),
        *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns if c != by],
    )
    px = left.select(
        F.col(by), F.col(left_ts).cast(rep_t).alias("_t"), F.lit(1).alias("_kind"),
        F.lit(None).cast(rep.schema["_rep"].dataType).alias("_rep"),
        *[F.col(c) for c in left.columns if c != by],
    )
    bucket = F.floor(F.datediff(F.col("_t"), F.lit("1970-01-01").cast("date")) / bucket_days)
    x = rep.unionByName(px).withColumn("_b", bucket)
    w = Window.partitionBy(by, "_b").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_local", F.max("_rep").over(w))
    # every (symbol, bucket) with any row gets a carry; price rows add null (ignored by max)
    per_bucket = x.groupBy(by, "_b").agg(F.max("_rep").alias("_m"))
    before = Window.partitionBy(by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(by, "_b", F.max("_m").over(before).alias("_carry"))
    # carry has one row per (symbol, bucket); AQE broadcasts it when small
    out = x.filter(F.col("_kind") == 1).join(carry, [by, "_b"], "left") \
           .withColumn("_last", F.greatest("_local", "_carry"))
    return out.select(
        *[F.col(c) for c in left.columns], *[F.col(f"_last.{v}").alias(v) for v in values])


def asof_join_fundamentals(prices: DataFrame, fundamentals: DataFrame,
                           current_only: bool = True, dedupe: bool = True, shuffle: bool = False) -> DataFrame:
    """Prices + current fundamentals as of each trade date, one row per
    (symbol, trade_date) (duplicate price rows are reduced first)."""
    fund = fundamentals.filter(F.col("is_current")) if current_only else fundamentals
    px = prices
    if dedupe:
        newest = [F.col("ingestion_ts").desc_nulls_last()] if "ingestion_ts" in px.columns else []
        px = first_per_group(px, ["symbol", "trade_date"], newest)
    return asof_join(px, fund, shuffle=shuffle)
