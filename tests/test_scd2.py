import datetime as dt

from pyspark.sql import functions as F

from sparkfolio.operators import scd2

D = dt.date
TS = dt.datetime(2024, 1, 1)
NEW_SCHEMA = ("symbol string, report_date date, pe_ratio double, debt_to_equity double, "
              "effective_date date, source_api string, ingestion_ts timestamp")


def _hist(spark):
    new = spark.createDataFrame([
        ("U", D(2023, 1, 1), 1.0, 1.0, D(2024, 1, 1), "fmp", TS),   # will be unchanged
        ("C", D(2023, 1, 1), 1.0, 1.0, D(2024, 1, 1), "fmp", TS),   # will change
        ("N", D(2023, 1, 1), 1.0, None, D(2024, 1, 1), "fmp", TS),  # null -> value
        ("K", D(2023, 1, 1), 1.0, 1.0, D(2024, 1, 1), "fmp", TS),   # absent from the batch
    ], NEW_SCHEMA)
    return scd2.scd2_init(new)


def _batch(spark, eff=D(2024, 6, 1)):
    return spark.createDataFrame([
        ("U", D(2023, 1, 1), 1.0, 1.0, eff, "fmp", TS),
        ("C", D(2023, 1, 1), 2.0, 1.0, eff, "fmp", TS),
        ("N", D(2023, 1, 1), 1.0, 5.0, eff, "fmp", TS),
        ("X", D(2023, 1, 1), 9.0, 9.0, eff, "fmp", TS),             # new key
    ], NEW_SCHEMA)


def _versions(df):
    return sorted(((r.symbol, r.is_current, r.pe_ratio, r.debt_to_equity, r.expiration_date) for r in df.collect()),
                  key=repr)


def test_merge_default(spark):
    m = scd2.scd2_merge(_hist(spark), _batch(spark), "2024-06-01")
    exp = D(2024, 6, 1)
    assert _versions(m) == sorted([
        ("U", True, 1.0, 1.0, None), ("K", True, 1.0, 1.0, None),
        ("C", False, 1.0, 1.0, exp), ("C", True, 2.0, 1.0, None),
        ("N", False, 1.0, None, exp), ("N", True, 1.0, 5.0, None),
        ("X", True, 9.0, 9.0, None),
    ])
    cur = scd2.current(m).groupBy("symbol", "report_date").count()
    assert cur.filter(F.col("count") > 1).count() == 0          # one current row per key


def test_merge_null_unsafe_and_reappend(spark):
    m = scd2.scd2_merge(_hist(spark), _batch(spark), "2024-06-01", null_safe=False, reappend_unchanged=True)
    got = _versions(m)
    assert ("N", False, 1.0, None, D(2024, 6, 1)) not in got      # null -> value is no change
    assert sum(1 for v in got if v[0] == "U" and v[1]) == 2       # unchanged appended again


def test_merge_idempotent_rerun(spark):
    once = scd2.scd2_merge(_hist(spark), _batch(spark), "2024-06-01")
    twice = scd2.scd2_merge(once, _batch(spark), "2024-06-01")
    assert _versions(once) == _versions(twice)


def test_reference_mode_rows(spark):
    m = scd2.scd2_merge_reference(_hist(spark), _batch(spark), "2024-06-01")
    got = _versions(m)
    # only C changes under "!=" (N's null -> 5 does not): U, N, K kept + C expired + all 4 incoming
    assert len(got) == 3 + 1 + 4
    assert sum(1 for v in got if v[1]) == 3 + 4


def test_as_of_view(spark):
    m = scd2.scd2_merge(_hist(spark), _batch(spark), "2024-06-01")
    before = {(r.symbol, r.pe_ratio) for r in scd2.as_of(m, "2024-03-01").collect()}
    assert before == {("U", 1.0), ("C", 1.0), ("N", 1.0), ("K", 1.0)}
    after = {(r.symbol, r.pe_ratio) for r in scd2.as_of(m, "2024-07-01").collect()}
    assert ("C", 2.0) in after and ("X", 9.0) in after and ("C", 1.0) not in after


def test_standardize_and_upgrade(spark):
    raw = spark.createDataFrame([("A", "2023-12-31", 10.0), (None, "2023-12-31", 1.0), ("B", "bad", 1.0)],
                                "symbol string, date string, priceToEarningsRatio double")
    std = scd2.standardize_fundamentals(raw, "2024-01-02")
    rows = std.collect()
    assert len(rows) == 1 and rows[0].debt_to_equity is None and rows[0].report_date == D(2023, 12, 31)
    legacy = std.select("symbol", "report_date", "pe_ratio", "debt_to_equity", "effective_date")
    up = scd2.upgrade_history(legacy)
    assert {"is_current", "expiration_date", "source_api", "ingestion_ts"} <= set(up.columns)


def test_merge_leaves_one_current_row_of_duplicates(spark):
    """The reference-mode merge appends unchanged rows again; the next merge reduces them to one."""
    twice = scd2.scd2_merge_reference(_hist(spark), _batch(spark), "2024-06-01")
    nulls = twice.limit(1).withColumns({"symbol": F.lit(None).cast("string"), "is_current": F.lit(True)})
    later = _batch(spark, D(2024, 9, 1)).filter("symbol IN ('U', 'C')").withColumn("pe_ratio", F.lit(7.0))
    m = scd2.scd2_merge(twice.unionByName(nulls).unionByName(nulls), later, "2024-09-01")
    assert m.count() == twice.count() + 4                       # nothing lost, two changed versions, two null keys
    cur = scd2.current(m).filter("symbol IS NOT NULL")
    assert cur.groupBy("symbol", "report_date").count().filter("count > 1").count() == 0
    u = sorted((r.effective_date, r.is_current, r.expiration_date) for r in m.filter("symbol = 'U'").collect())
    assert u == [(D(2024, 1, 1), False, D(2024, 6, 1)), (D(2024, 6, 1), False, D(2024, 9, 1)), (D(2024, 9, 1), True, None)]
    assert m.filter("symbol IS NULL AND is_current").count() == 2
