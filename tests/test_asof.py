import datetime as dt

from pyspark.sql import functions as F

from sparkfolio.operators import asof

D = dt.date


def _prices(spark):
    return spark.createDataFrame([
        ("A", D(2024, 1, 1), 1.0), ("A", D(2024, 3, 31), 2.0), ("A", D(2024, 4, 1), 3.0),
        ("A", D(2025, 6, 1), 4.0), ("B", D(2024, 5, 1), 5.0),
    ], "symbol string, trade_date date, close double")


def _reports(spark):
    return spark.createDataFrame([
        ("A", D(2024, 3, 31), 10.0, 1.0, D(2024, 4, 1), True),
        ("A", D(2024, 3, 31), 11.0, 1.1, D(2024, 5, 1), True),     # tie on date: later effective wins
        ("A", D(2025, 1, 1), None, 2.0, D(2025, 1, 2), True),      # newest report has a null ratio
        ("B", D(2024, 6, 1), 7.0, 7.0, D(2024, 6, 1), True),       # after the only B price
    ], "symbol string, report_date date, pe_ratio double, debt_to_equity double, "
       "effective_date date, is_current boolean")


def _as_dict(df):
    return {(r.symbol, r.trade_date): (r.pe_ratio, r.debt_to_equity) for r in df.collect()}


def test_asof_semantics(spark):
    got = _as_dict(asof.asof_join(_prices(spark), _reports(spark)))
    assert got[("A", D(2024, 1, 1))] == (None, None)          # before the first report
    assert got[("A", D(2024, 3, 31))] == (11.0, 1.1)          # equal date counts; tie broken
    assert got[("A", D(2024, 4, 1))] == (11.0, 1.1)
    assert got[("A", D(2025, 6, 1))] == (None, 2.0)           # null kept, not back-filled
    assert got[("B", D(2024, 5, 1))] == (None, None)


def test_asof_forms_agree(spark):
    p, r = _prices(spark), _reports(spark)
    a = _as_dict(asof.asof_join(p, r))
    assert a == _as_dict(asof.asof_join(p, r, shuffle=True))
    assert a == _as_dict(asof.asof_join_union(p, r))


def test_asof_runs_no_job_and_leaves_the_join_to_measured_sizes(spark):
    p, r = _prices(spark), _reports(spark)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    small, big = asof.asof_join(p, r), asof.asof_join(p, r, shuffle=True)
    union = asof.asof_join_union(p, r)
    assert len(tracker.getJobIdsForGroup(None)) == before
    for df in (small, big, union):
        df.collect()
    plans = [df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0] for df in (small, big)]
    assert "BroadcastHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[1] and "SortMergeJoin" in plans[1]
    assert "ResolvedHint" not in plans[0]


def test_first_per_group_dedupes_copies(spark):
    df = spark.createDataFrame([("A", 1, 5.0), ("A", 1, 5.0), ("A", 1, 6.0), ("B", 2, 1.0)],
                               "symbol string, d int, v double")
    out = asof.first_per_group(df, ["symbol", "d"], [F.col("v").desc()]).collect()
    assert sorted((r.symbol, r.v) for r in out) == [("A", 6.0), ("B", 1.0)]


def test_asof_union_carries_across_empty_buckets(spark):
    p = spark.createDataFrame([("A", D(2030, 1, 1), 9.0), ("A", D(2020, 5, 1), 8.0)],
                              "symbol string, trade_date date, close double")
    r = spark.createDataFrame([("A", D(2020, 1, 1), 3.0, None, D(2020, 1, 2), True)],
                              "symbol string, report_date date, pe_ratio double, debt_to_equity double, "
                              "effective_date date, is_current boolean")
    want = {("A", D(2030, 1, 1)): (3.0, None), ("A", D(2020, 5, 1)): (3.0, None)}
    assert _as_dict(asof.asof_join_union(p, r)) == want
    assert _as_dict(asof.asof_join(p, r)) == want
