from pathlib import Path

from pyspark.sql import functions as F

from sparkfolio.schemas import RAW_PRICES
from sparkfolio.session import scratch_path, unique_name
from sparkfolio.sources import landing as ld
from sparkfolio.sources import readers as rd
from sparkfolio.sources import writers as wr


def test_table_exists_only_path_not_found(spark):
    assert not rd.table_exists(spark, scratch_path(spark, "missing"))


def test_partition_pruning_on_dt(spark):
    root = scratch_path(spark, "json")
    df = spark.createDataFrame([("1999-01", '{"meta": {"symbol": "A"}, "values": []}'),
                                ("1999-02", '{"meta": {"symbol": "B"}, "values": []}')], "dt string, value string")
    df.write.partitionBy("dt").text(root)
    pruned = rd.read_json(spark, root, RAW_PRICES, where=F.col("dt") == "1999-02")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert [r.meta.symbol for r in pruned.collect()] == ["B"]


def test_dynamic_overwrite_replaces_only_present_partitions(spark):
    path = scratch_path(spark, "dyn")
    a = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 1.0), ("A", 2, 1.0)], "symbol string, d int, v double")
    wr.write_partitions(a, path, ["d"])
    wr.write_partitions(spark.createDataFrame([("A", 1, 9.0)], "symbol string, d int, v double"), path, ["d"])
    got = sorted((r.symbol, r.d, r.v) for r in rd.read_table(spark, path).collect())
    assert got == [("A", 1, 9.0), ("A", 2, 1.0)]          # B vanished from d=1 only


def test_publish_snapshot_self_overwrite(spark):
    root, name = scratch_path(spark, "snap"), unique_name("t")
    wr.publish_snapshot(spark, spark.range(3), name, root)
    wr.publish_snapshot(spark, spark.table(name).withColumn("id", F.col("id") * 10), name, root)
    assert sorted(r.id for r in spark.table(name).collect()) == [0, 10, 20]


def test_register_external_declared_columns(spark):
    from pyspark.sql import types as T
    path = scratch_path(spark, "ext")
    spark.range(2).withColumn("x", F.lit(1.0)).withColumn("y", F.lit("s")).write.parquet(path)
    t = wr.register_external(spark, unique_name("ext"), path,
                             T.StructType([T.StructField("id", T.LongType()), T.StructField("y", T.StringType())]))
    assert t.columns == ["id", "y"] and t.count() == 2


def test_landing_new_only_and_summary(spark):
    root = scratch_path(spark, "landing")
    rows = [("prices", "d1", "A", '{"meta": {}}'), ("prices", "d1", "B", '{"status": "error"}'),
            ("ratios", "d1", "A", "[]"), ("ratios", "d1", "B", '{"Error Message": "x"}'),
            ("ratios", "d2", "A", '[{"symbol": "A"}]')]
    incoming = spark.createDataFrame(rows, "source string, dt string, symbol string, body string")
    assert sorted(r.outcome for r in ld.classify_payloads(incoming).collect()) == \
        ["empty", "error", "error", "ok", "ok"]
    ld.land_new(spark, incoming.filter(F.col("dt") == "d1"), root)
    summary = {(r.source, r.outcome): r.n for r in
               ld.landing_summary(incoming, ld.landed_keys(spark, root)).collect()}
    assert summary == {("prices", "skipped"): 1, ("prices", "failed"): 1, ("ratios", "failed"): 2,
                       ("ratios", "fetched"): 1}
    ld.land_new(spark, incoming, root)
    ld.land_new(spark, incoming, root)                      # rerun lands nothing twice
    keys = sorted((r.source, r.dt, r.symbol) for r in ld.read_landed(spark, root).collect())
    assert keys == [("prices", "d1", "A"), ("ratios", "d2", "A")]


def test_is_empty_and_empty_like(spark):
    df = spark.range(5)
    assert not rd.is_empty(df)
    e = rd.empty_like(df)
    assert rd.is_empty(e) and e.schema == df.schema


PAYLOAD = "source string, dt string, symbol string, body string"


def _files(root):
    return sorted(str(p.relative_to(root)) for p in Path(root).rglob("*.parquet"))


def _local(spark, name):
    return scratch_path(spark, name).removeprefix("file:")


def test_landing_opens_the_folders_of_its_dates_only(spark):
    root = _local(spark, "landing")
    rows = [("prices", f"2024-01-{i:02d}", "A", '{"meta": {}}') for i in range(1, 4)]
    ld.land_new(spark, spark.createDataFrame(rows, PAYLOAD), root)
    # ledger rows of other dates cannot be read any more: a run of one date does not notice
    for p in Path(root).glob("ledger/dt=2024-01-0[13]/*.parquet"):
        p.write_bytes(b"broken")
    keys = ld.landed_keys(spark, root, dts=["2024-01-02", "2024-01-09"])
    assert [f for f in keys.inputFiles() if "dt=2024-01-02" not in f] == []
    batch = spark.createDataFrame([("prices", "2024-01-02", s, '{"meta": {}}') for s in "AB"], PAYLOAD)
    assert [r.symbol for r in ld.land_new(spark, batch, root).collect()] == ["B"]


def test_second_landing_writes_no_file(spark):
    root = _local(spark, "landing")
    rows = [("prices", "d/1", "A", '{"meta": {}}'), ("ratios", "d2", "B", '[{"symbol": "B"}]')]
    incoming = spark.createDataFrame(rows, PAYLOAD)
    ld.land_new(spark, incoming, root)
    before = {f: (Path(root) / f).stat().st_mtime for f in _files(root)}
    assert ld.land_new(spark, incoming, root).collect() == []
    assert {f: (Path(root) / f).stat().st_mtime for f in _files(root)} == before
    assert sorted(r.dt for r in ld.read_landed(spark, root).collect()) == ["d/1", "d2"]


def test_payloads_of_a_run_without_ledger_rows_are_not_seen(spark):
    root = _local(spark, "landing")
    a, b = (spark.createDataFrame([("prices", "d1", s, '{"meta": {}}')], PAYLOAD) for s in "AB")
    ld.land_new(spark, a, root)
    done = set(_files(f"{root}/ledger"))
    ld.land_new(spark, b, root)
    for f in set(_files(f"{root}/ledger")) - done:
        (Path(root) / "ledger" / f).unlink()              # the run died before its commit
    assert [r.symbol for r in ld.read_landed(spark, root).collect()] == ["A"]
    ld.land_new(spark, b, root)
    assert sorted(r.symbol for r in ld.read_landed(spark, root).collect()) == ["A", "B"]


def test_landing_keeps_bodies_whole(spark):
    root = scratch_path(spark, "landing")
    odd = '{\n  "meta": {"symbol": "0700"},\r\n  "values": []\n}'
    rows = [("prices", "d1", "0700", odd), ("prices", "d1", "R", '{"meta": {"symbol": "R"}, "meta": {"symbol": "R2"}}'),
            ("prices", "d1", "V", '{"meta": {"symbol": "V", "v": NaN}}'), ("ratios", "d1", "V", '[{"symbol": "V", "peg": -Infinity}]'),
            ("prices", "d1", "H", "<html>502</html>"), ("prices", "d1", "N", None), ("prices", "d1", "T", '{"meta": '),
            ("prices", "d1", "X", '{"meta": {}} <html>'), ("prices", "d1", "Q", '"text"'), ("prices", "d1", None, '{"meta": {}}'),
            ("ratios", "d1", "A", '[{"symbol": "A"}]'), ("ratios", "d1", "A", '[{"symbol": "A", "date": "x"}]'),
            ("ratios", "d1", "S", '{"status": "error"}'), ("prices", "d1", "E", '{"Error Message": "x"}'), ("ratios", "d1", "E", '{"Error Message": null}'),
            ("prices", "d1", "P", '{"status": "error"}'), ("ratios", "d1", "B", " [] ")]
    incoming = spark.createDataFrame(rows, PAYLOAD)
    reasons = {(r.source, r.symbol): r.reason for r in ld.classify_payloads(incoming).collect()}
    assert {k: v for k, v in reasons.items() if v} == {
        ("prices", "H"): "no JSON", ("prices", "N"): "blank", ("prices", "T"): "no JSON", ("prices", "X"): "no JSON", ("prices", "Q"): "no JSON",
        ("prices", None): "no key", ("ratios", "E"): "error message", ("prices", "P"): "status error", ("ratios", "B"): "blank"}
    ld.land_new(spark, incoming, root)
    landed = {(r.source, r.symbol): r.value for r in ld.read_landed(spark, root).collect()}
    assert set(landed) == {k for k, v in reasons.items() if v is None} and landed["prices", "0700"] == odd
    docs = ld.read_documents(spark, root, "prices", RAW_PRICES, "d1").filter("meta IS NOT NULL").collect()
    assert {r.key_symbol: r.meta.symbol for r in docs} == {"0700": "0700", "R": "R2", "V": "V"}
    assert ld.read_documents(spark, root, "prices", RAW_PRICES, "d9") is None


def test_documents_lose_nothing_silently(spark):
    texts = ['{"meta": {"symbol": "A"}, "values": [{"datetime": "d", "open": 1.5, "x": {"y": [1]}}], "new": 1, "new": 2}',
             '{"meta": {"symbol": "B", "tz": "UTC"}, "values": "none"}', "[1, {\"meta\": {\"symbol\": \"C\"}}, null]", "{", None, "  ", "[]"]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, n int")
    parsed = rd.parse_documents(df, RAW_PRICES, keep={"n": "n"})
    rows = sorted(parsed.collect(), key=lambda r: (r.n, r.meta.symbol if r.meta else ""))
    assert [(r.n, r.meta.symbol if r.meta else None) for r in rows] == [(0, "A"), (1, "B"), (2, None), (2, None), (2, "C"), (3, None)]
    assert rows[0]["values"][0].open == "1.5"
    aside = sorted((r.n, r.reason, r.path, r.value) for r in rd.quarantine(parsed, ("n",)).collect())
    assert aside == [(0, "undeclared", "new", "1"), (0, "undeclared", "new", "2"), (0, "undeclared", "values[0].x", '{"y":[1]}'),
                     (1, "broken", "", texts[1]), (1, "undeclared", "meta.tz", "UTC"), (2, "broken", "", "1"), (2, "broken", "", "null"), (3, "broken", "", "{")]
