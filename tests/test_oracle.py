"""Every registered query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, rows_of

SLOW = {"ml_cv_report", "ml_scored", "future_scored"}   # a whole grid each: run together below


def _llm():
    """Queries of the optional subpackage; their tests are in tests/llm."""
    import __spark_entry__
    return set(__spark_entry__._llm()[0])


def _keys():
    from __spark_entry__ import oracle_sql, queries
    q, o = queries(), oracle_sql()
    return [k for k in q if k in o and k not in SLOW | _llm()]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, con, key):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[key](spark, SF_SMALL)
    res = con.execute(oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, res.fetchall())


def test_model_queries_match_their_oracles(spark, con, monkeypatch):
    """With one fit for the three."""
    from sparkfolio.plans import queries as q
    fits = {}
    monkeypatch.setattr(q, "_cv_model", lambda spark, sf, f=q._cv_model: fits.setdefault(sf, fits.get(sf) or f(spark, sf)))
    for key in sorted(SLOW):
        test_query_matches_oracle(spark, con, key)


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries
    assert set(queries()) - set(oracle_sql()) - _llm() == set()


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0 and "sharpe_ratio" in df.columns
