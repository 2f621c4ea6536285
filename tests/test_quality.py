import datetime as dt

from pyspark.sql import functions as F

from sparkfolio.operators import quality as qa
from sparkfolio.schemas import RAW_PRICES

D = dt.date(2024, 1, 2)


def _rows(spark, rows):
    return spark.createDataFrame(
        rows, "symbol string, trade_date date, open double, high double, low double, close double, volume bigint")


def test_validity_rules_first_match(spark):
    df = _rows(spark, [
        ("ok", D, 1.0, 2.0, 0.5, 1.5, 10),
        ("zero_close", D, 0.0, 0.0, 0.0, 0.0, 0),       # zero passes (only < 0 rejected)
        ("null_close", D, 1.0, 2.0, 0.5, None, 10),
        ("neg_close", D, 1.0, 2.0, 0.5, -1.0, 10),
        ("null_vol", D, 1.0, 2.0, 0.5, 1.5, None),
        ("neg_vol", D, 1.0, 2.0, 0.5, 1.5, -5),
        ("no_date", None, 1.0, 2.0, 0.5, 1.5, 10),
        ("open_gt_high", D, 3.0, 2.0, 0.5, 1.5, 10),
        ("low_gt_close", D, 1.0, 2.0, 1.6, 1.5, 10),
        ("null_ohl", D, None, None, None, 1.5, 10),      # null comparisons fall through
    ])
    got = {r.symbol: r.is_valid for r in qa.add_validity(df).collect()}
    assert got == {"ok": True, "zero_close": True, "null_close": False, "neg_close": False,
                   "null_vol": False, "neg_vol": False, "no_date": False, "open_gt_high": False,
                   "low_gt_close": False, "null_ohl": True}


def test_flatten_null_on_bad_values_and_null_array(spark):
    docs = spark.createDataFrame([
        ({"symbol": "A", "interval": "1day"},
         [{"datetime": "2024-01-02", "open": "1", "high": "2", "low": "0.5", "close": "n/a", "volume": "7"},
          {"datetime": "bad", "open": "x", "high": "2", "low": "0.5", "close": "1.5", "volume": "1.5e3"}]),
        ({"symbol": "B", "interval": "1day"}, None),
    ], RAW_PRICES)
    rows = qa.flatten_prices(docs).orderBy(F.col("trade_date").asc_nulls_last()).collect()
    assert len(rows) == 2                     # the null array yields nothing
    assert rows[0].close is None and rows[0].volume == 7 and rows[0].trade_date == D
    assert rows[1].trade_date is None and rows[1].open is None


def test_split_counts_and_sample(spark):
    df = _rows(spark, [("A", D, 1.0, 2.0, 0.5, 1.5, 10), ("A", D, 1.0, 2.0, 0.5, -1.0, 10),
                       ("B", D, 1.0, 2.0, 0.5, None, 10)])
    valid, invalid = qa.split_valid(df)
    assert valid.count() == 1 and invalid.count() == 2
    counts = {r.symbol: (r.valid_rows, r.invalid_rows) for r in qa.validity_counts(df).collect()}
    assert counts == {"A": (1, 1), "B": (0, 1)}
    assert qa.invalid_sample(df, 1).count() == 1


def test_null_report_counts_nulls_and_nan(spark):
    df = spark.createDataFrame([(1.0, None), (float("nan"), D), (None, D)], "close double, trade_date date")
    r = qa.null_report(df, ["close", "trade_date"]).first()
    assert r.nb_null_close == 2 and r.nb_null_trade_date == 1


def test_ensure_fill_drop(spark):
    import pyspark.sql.types as T
    df = spark.createDataFrame([(1, None), (2, 3.0)], "id int, x double")
    e = qa.ensure_columns(df, {"x": T.DoubleType(), "y": T.DoubleType()})
    assert e.schema["y"].dataType == T.DoubleType()
    assert [r.x for r in qa.fill_missing(e, ["x"]).orderBy("id").collect()] == [0.0, 3.0]
    assert qa.drop_missing(e, ["x"]).count() == 1
