"""Whitening against numpy on the whole matrix, and on odd rows."""

import collections
import math

import numpy as np
import pyarrow.parquet as pq
import pytest

from sparkfolio.llm import queries, whitening
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<float>, label int, x int, rows int, white int, `a.b` int"


def plain(vectors, weights="one", most=4):
    xs = [tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in vectors]
    fit = list(dict.fromkeys(xs)) if weights == "one" else xs
    n, d = len(fit), len(fit[0])
    sums = [sum(v[j] for v in fit) for j in range(d)]
    mean = np.array([s / n for s in sums])
    centred = np.array(fit, float) - mean
    cov = centred.T @ centred / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    white = (np.array(xs, float) - mean) @ axes / np.sqrt(values)
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in xs]
    return n, deviation, white, values / np.trace(cov)


def compare(df, rows, weights="one"):
    n, deviation, white, explained = plain([v for _, v in rows], weights)
    got = collections.defaultdict(list)
    for r in df.collect():
        got[r.vec_id].append(r)
    assert sum(map(len, got.values())) == len(rows)
    signs = None
    for (i, _), dev, w in zip(rows, deviation, white):
        r = got[i][0]
        assert (r.n, r.deviation_exact) == (n, str(dev)) and r.deviation == (dev if dev < 2**63 else None)
        assert r.identity_error <= 1e-4 and np.allclose(r.explained, explained, rtol=1e-6)
        signs = np.sign(np.array(r.whitened) * w) if signs is None else signs
        assert np.allclose(np.array(r.whitened) * signs, w, atol=1e-6)


@pytest.mark.parametrize("weights", ["one", "count"])
def test_copies(spark, monkeypatch, weights):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 6)).astype(np.float32)
    rows = [(i, base[i % 40].tolist() if i < 200 else base[0].tolist()) for i in range(400)]
    monkeypatch.setattr(whitening, "HOT_ROWS", 30)
    bad = [(1000, None), (1001, []), (1002, [1.0] * 5 + [None]), (1003, [1.0] * 5 + [float("nan")]),
           (1004, [1.0] * 5 + [float("inf")]), (1005, [1e30] * 6), (1006, [1.0] * 7)]
    df = spark.createDataFrame([(i, v, 0, 1, 2, 3, 4) for i, v in rows + bad], SCHEMA).repartition(5)
    compare(whitening.whiten(df, weights=weights), rows, weights)


def test_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pylist()]
    df = whitening.whiten(spark.read.parquet(f"{SF_SMALL}/embeddings.parquet"))
    compare(df, rows)
    long = queries.op13_whitening(spark, SF_SMALL)
    assert long.columns[:7] == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    by = collections.Counter(r.component for r in long.collect())
    assert by == {k: len(rows) for k in (1, 2, 3, 4)}


def test_large_numbers(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=3) * 1e13).astype(np.float32).tolist()) for i in range(30)]
    compare(whitening.whiten(spark.createDataFrame([(i, v, 0, 0, 0, 0, 0) for i, v in rows], SCHEMA)), rows)


def test_no_variance_and_none(spark):
    same = spark.createDataFrame([(i, [0.5, 0.25], 0, 0, 0, 0, 0) for i in (1, 1, 2, None)], SCHEMA)
    out = whitening.whiten(same).collect()
    assert len(out) == 4 and all(r.whitened == [] and r.explained == [] and r.n == 1 and r.deviation == 0 for r in out)
    line = spark.createDataFrame([(i, [float(i), 0.0], 0, 0, 0, 0, 0) for i in range(4)], SCHEMA)
    assert all(len(r.whitened) == 1 for r in whitening.whiten(line).collect())
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 0, 0, 0, 0, 0)], SCHEMA)).collect() == []
