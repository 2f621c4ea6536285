"""Plan-shape checks for the scale properties the README claims."""

import re

from sparkfolio.operators import backtest as bt
from sparkfolio.operators import features as ft
from sparkfolio.operators import metrics as mt
from sparkfolio.operators import quality as qa
from sparkfolio.operators import scd2
from sparkfolio.plans import fixtures as fx


def _plan(df):
    """The plan that ran: adaptive execution ends with the frame's own collect."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "isFinalPlan=false" not in plan
    return re.sub(r"#\d+", "", plan)


def test_gold_features_broadcast_asof_and_one_window_exchange(spark, sf_small):
    plan = _plan(ft.gold_features(fx.bars(spark, sf_small), fx.fund(spark, sf_small)))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # the bars aggregate + ONE exchange for the whole indicator/feature block
    assert len(re.findall(r"Exchange hashpartitioning\(symbol, \d+\)", plan)) == 1


def test_metrics_partial_aggregation(spark, sf_small):
    plan = _plan(mt.backtest_metrics(bt.backtest(fx.pred(spark, sf_small))))
    assert "partial_max(cum_strategy_return)" in plan and "partial_stddev" in plan


def test_validity_counts_partial_aggregation(spark, sf_small):
    plan = _plan(qa.validity_counts(qa.flatten_prices(fx.raw_docs(spark, sf_small))))
    assert "partial_count_if" in plan or "partial_count(" in plan


def test_scd2_merge_single_join_no_extra_exchange(spark, sf_small):
    merged = scd2.scd2_merge(fx.fund_old(spark, sf_small), fx.fund_incoming(spark, sf_small), fx.FUND_EFFECTIVE)
    plan = _plan(merged)
    assert plan.count("FullOuter") == 1
    # only the two fixture aggregates shuffle; the merge join reuses their partitioning
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 3


def test_chunked_backtest_shuffles_its_rows_once_for_the_series(spark, sf_small):
    plan = _plan(bt.backtest(fx.pred(spark, sf_small), chunk_rows=64, rank_buckets=4))
    assert len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (?:hash|range|round|single)", plan)) < 10
    assert len(re.findall(r"\+- Exchange hashpartitioning\(symbol, _chunk", plan)) == 1 and "ReusedExchange" in plan


def test_standardize_names_its_statistics_once(spark, sf_small):
    from sparkfolio.operators import model as md
    df = md.standardize(spark.range(9).selectExpr("id * 1.0D AS a", "id % 4 * 1.0D AS b"), ["a", "b"])
    optimised = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimised.count("scalar-subquery") == 1
