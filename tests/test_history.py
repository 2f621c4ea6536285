"""Stored history: merges rewrite what changes, versions stay readable, retention drops what none names."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sparkfolio.operators import scd2
from sparkfolio.plans import fixtures as fx
from sparkfolio.session import scratch_path, unique_name
from sparkfolio.sources import history as hs

NEW = "symbol string, report_date date, pe_ratio double, debt_to_equity double, effective_date date, source_api string, ingestion_ts timestamp"


def _batch(spark, rows, effective):
    day = dt.date.fromisoformat(effective)
    return spark.createDataFrame([(s, dt.date.fromisoformat(d) if d else None, p, 1.0, day, "fmp", dt.datetime(2024, 1, 1)) for s, d, p in rows], NEW)


def _rows(df):
    return sorted((tuple(r) for r in df.select(*scd2.HISTORY_COLUMNS).collect()), key=repr)


def _files(root):
    return {str(p): p.stat().st_mtime_ns for p in Path(root.removeprefix("file:")).glob("parts/**/*.parquet")}


def test_merge_equals_the_plain_one(spark, sf_small):
    root = scratch_path(spark, "hist")
    old, new = fx.fund_old(spark, sf_small), fx.fund_incoming(spark, sf_small)
    hs.start(spark, root, old)
    done = hs.merge(spark, root, new, fx.FUND_EFFECTIVE)
    assert _rows(hs.read_history(spark, root)) == _rows(scd2.scd2_merge(old, new, fx.FUND_EFFECTIVE))
    counts = scd2.change_counts(scd2.current(old), new).first()
    assert (done["changed"], done["new"]) == (counts.changed_null_safe, counts.new_keys)
    assert _rows(hs.read_history(spark, root, version=1)) == _rows(old)


@pytest.mark.parametrize("again", [False, True])
def test_untouched_parts_keep_their_files(spark, again):
    root = scratch_path(spark, "hist")
    first = [("A", "2020-03-31", 1.0), ("A", "2021-03-31", 2.0), ("B", "2021-03-31", 3.0), (None, None, 9.0)]
    hs.merge(spark, root, _batch(spark, first, "2022-01-01"), "2022-01-01")
    before = _files(root)
    hs.merge(spark, root, _batch(spark, [("A", "2021-03-31", 2.5), ("C", "2022-03-31", 4.0), ("A", "2020-03-31", 1.0)], "2023-01-01"), "2023-01-01",
             reappend_unchanged=again)
    parts = {(p.is_current, p.period): p for p in hs.parts(spark, root)}
    expected = {(True, 2020): 2 if again else 1, (True, 2021): 2, (True, 2022): 1, (False, 2021): 1, (True, None): 1}
    assert {k: p.n_rows for k, p in parts.items()} == expected
    after = _files(root)
    assert all(after[f] == t for f, t in before.items())
    same = {k for k, p in parts.items() if any(p.path in f for f in before)}
    assert same == {(True, None)} | (set() if again else {(True, 2020)})
    # only parts of the chosen years are opened
    chosen = hs.read_history(spark, root, current=True, periods=[2021])
    assert all("_period=2021" in f for f in chosen.inputFiles()) and chosen.count() == 2
    closed = hs.read_history(spark, root, current=False).first()
    assert (closed.pe_ratio, closed.expiration_date, closed.is_current) == (2.0, dt.date(2023, 1, 1), False)


def test_a_batch_without_change_publishes_nothing(spark):
    root = scratch_path(spark, "hist")
    batch = _batch(spark, [("A", "2020-03-31", 1.0), ("A", "2020-03-31", 1.0)], "2022-01-01")
    assert hs.merge(spark, root, batch, "2022-01-01")["version"] == 1
    before = _files(root)
    assert hs.merge(spark, root, batch, "2023-01-01") == {"version": 1, "changed": 0, "new": 0, "periods": []}
    assert _files(root) == before and hs.read_history(spark, root).count() == 1
    empty = scratch_path(spark, "hist")
    assert hs.merge(spark, empty, batch.limit(0), "2022-01-01")["version"] == 0
    assert hs.read_history(spark, empty).count() == 0 and hs.versions(spark, empty) == []


def test_many_closed_parts_are_joined(spark, monkeypatch):
    monkeypatch.setattr(hs, "MAX_CLOSED_PARTS", 2)
    root = scratch_path(spark, "hist")
    for i in range(6):
        hs.merge(spark, root, _batch(spark, [("A", "2020-03-31", float(i))], f"202{i}-01-01"), f"202{i}-01-01")
    closed = [p for p in hs.parts(spark, root) if not p.is_current]
    assert len(closed) <= 3 and sum(p.n_rows for p in closed) == 5
    assert sorted(r.pe_ratio for r in hs.read_history(spark, root).collect()) == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]


def test_retention(spark):
    root, name = scratch_path(spark, "hist"), unique_name("hist")
    for i in range(4):
        hs.merge(spark, root, _batch(spark, [("A", "2020-03-31", float(i)), ("B", "2019-03-31", 1.0)], f"202{i}-01-01"), f"202{i}-01-01")
    Path(f"{root.removeprefix('file:')}/parts/run=dead/_current=true").mkdir(parents=True)
    want = {v: _rows(hs.read_history(spark, root, version=v)) for v in (3, 4)}
    dropped = hs.vacuum(spark, root, keep=2)
    assert hs.versions(spark, root) == [3, 4]
    assert {v: _rows(hs.read_history(spark, root, version=v)) for v in (3, 4)} == want
    assert sum(d.startswith("manifests") for d in dropped) == 2 and "parts/run=dead" in dropped
    named = {p.path for v in (3, 4) for p in hs.parts(spark, root, v)}
    assert all(any(n in f for n in named) for f in _files(root)) and hs.vacuum(spark, root, keep=2) == []
    hs.publish_view(spark, root, name)
    assert _rows(spark.table(name)) == want[4]
    hs.merge(spark, root, _batch(spark, [("C", "2018-03-31", 1.0)], "2025-01-01"), "2025-01-01")
    hs.publish_view(spark, root, name)
    assert spark.table(name).count() == len(want[4]) + 1


def test_a_manifest_without_its_mark_is_not_read(spark):
    root = scratch_path(spark, "hist")
    hs.merge(spark, root, _batch(spark, [("A", "2020-03-31", 1.0)], "2022-01-01"), "2022-01-01")
    Path(f"{root.removeprefix('file:')}/manifests/version=2").mkdir()
    assert hs.versions(spark, root) == [1] and hs.read_history(spark, root).count() == 1


def test_start_closes_older_versions_and_refuses_a_second_time(spark):
    root = scratch_path(spark, "hist")
    old = scd2.scd2_init(_batch(spark, [("A", "2020-03-31", 1.0)], "2021-01-01").unionByName(_batch(spark, [("A", "2020-03-31", 2.0)], "2022-01-01")))
    hs.start(spark, root, old)
    got = {r.pe_ratio: (r.is_current, r.expiration_date) for r in hs.read_history(spark, root).collect()}
    assert got == {1.0: (False, dt.date(2022, 1, 1)), 2.0: (True, None)}
    with pytest.raises(ValueError):
        hs.start(spark, root, old.filter(F.lit(False)))
