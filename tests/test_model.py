from sparkfolio.operators import features as ft
from sparkfolio.operators import model as md
from sparkfolio.plans import fixtures as fx


def test_cv_scores_test_rows_reproducibly(spark, sf_small):
    ready = md.train_ready(ft.gold_features(fx.bars(spark, sf_small), fx.fund(spark, sf_small)))
    train, test = md.time_split(ready, fx.SPLIT_DATE)
    grid = {"maxDepth": (2,), "maxIter": (3,)}
    m1 = md.tune(train, grid, folds=2)
    scored = md.score(m1, test)
    assert scored.count() == test.count()
    assert scored.filter("prediction IS NULL").count() == 0
    m2 = md.tune(train, grid, folds=2)
    assert list(m1.avgMetrics) == list(m2.avgMetrics)
    rep = md.cv_report(spark, m1).collect()
    assert len(rep) == 1 and rep[0].is_best


def test_standardize_small(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    got = sorted(((r.a, r.a_z, r.b_z) for r in md.standardize(df, ["a", "b"]).collect()), key=repr)
    h = 0.5 ** 0.5
    assert got[0][0] == 1.0 and abs(got[0][1] + h) < 1e-12 and abs(got[1][1] - h) < 1e-12
    assert got[2][1] is None and [r[2] for r in got] == [0.0] * 3


def test_latest_date_is_pushed_to_the_scan(spark):
    from sparkfolio.operators import scoring as sc
    from sparkfolio.session import scratch_path
    path = scratch_path(spark, "by-date")
    spark.range(10).selectExpr("date_add(date'2024-01-01', cast(id % 5 as int)) AS trade_date", "id").write.parquet(path)
    latest = sc.latest_rows(spark.read.parquet(path), require=["id"])
    assert sorted(r.id for r in latest.collect()) == [4, 9]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: [isnotnull(trade_date" in plan and "(trade_date" in plan.split("DataFilters:")[1] and "Join" not in plan


def test_latest_date_of_a_stored_table_reads_no_row_group(spark):
    import datetime as dt

    from sparkfolio.operators import scoring as sc
    from sparkfolio.session import scratch_path
    from sparkfolio.sources import readers as rd
    path = scratch_path(spark, "by-symbol")
    spark.range(100).selectExpr("date_add(date'2024-01-01', cast(id % 7 as int)) AS trade_date", "id", "cast(id % 3 as string) AS symbol") \
        .write.partitionBy("symbol").parquet(path)
    aside = spark.newSession()
    aside.conf.set("spark.sql.sources.useV1SourceList", "")
    aside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = aside.read.parquet(path).agg({"trade_date": "max"})._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(trade_date)]" in plan
    assert rd.stored_max(spark, path, "trade_date") == dt.date(2024, 1, 7) and "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
    df = spark.read.parquet(path)
    known = sc.latest_rows(df, require=["id"], date=rd.stored_max(spark, path, "trade_date"))
    assert sorted(known.collect()) == sorted(sc.latest_rows(df, require=["id"]).collect())
    assert known._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    empty = scratch_path(spark, "none")
    df.limit(0).write.parquet(empty)
    assert rd.stored_max(spark, empty, "trade_date") is None


def test_no_training_date_reaches_a_test_block(spark):
    import datetime as dt
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=3 * i) for i in range(23)]
    df = spark.createDataFrame([(s, d) for s in "AB" for d in days] + [("C", days[5]), ("C", None)], "symbol string, trade_date date")
    for folds, gap in ((3, 1), (4, 0), (2, 6)):
        rows = md.walk_forward_folds(df, folds, gap).collect()
        tested = []
        for k in range(1, folds + 1):
            train, test = ({r.trade_date for r in rows if r.fold == k and r.role == role} for role in ("train", "test"))
            first = days.index(min(test))
            assert train == set(days[:max(0, first - gap)]) and test == set(days[first:days.index(max(test)) + 1])
            tested += sorted(test)
        assert tested == days[len(days) // (folds + 1):]          # each later date is tested once
        assert sum(r.symbol == "C" for r in rows) > 0 and all(r.trade_date for r in rows)


def test_walk_forward_tuning(spark, sf_small):
    ready = md.train_ready(ft.gold_features(fx.bars(spark, sf_small), fx.fund(spark, sf_small)))
    model = md.tune_walk_forward(ready, {"maxDepth": (2, 3), "maxIter": (2,)}, folds=2, parallelism=2)
    assert [len(m) for m in model.foldMetrics] == [2, 2]
    assert sum(r.is_best for r in md.cv_report(spark, model).collect()) == 1
    assert md.score(model, ready).filter("prediction IS NULL").count() == 0
    # a fold by hand
    fold = md.walk_forward_folds(ready, 2, md.LABEL_GAP).filter("fold = 1")
    pipeline, gbt = md.build_estimator(maxDepth=2, maxIter=2)
    fitted = pipeline.fit(fold.filter("role = 'train'").drop("fold", "role"))
    rmse = md.rmse_evaluator().evaluate(fitted.transform(fold.filter("role = 'test'")))
    assert abs(rmse - model.foldMetrics[0][0]) < 1e-3
