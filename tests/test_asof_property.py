"""As-of join forms vs a brute-force Python as-of on random small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkfolio.operators import asof

BASE = dt.date(2019, 6, 1)
day = st.integers(min_value=0, max_value=1500).map(lambda d: BASE + dt.timedelta(days=d))
sym = st.sampled_from(["A", "B", "C"])
ratio = st.one_of(st.none(), st.integers(min_value=1, max_value=50).map(float))
prices_st = st.lists(st.tuples(sym, day), min_size=1, max_size=25, unique=True)
reports_st = st.lists(st.tuples(sym, day, ratio, ratio), min_size=0, max_size=12,
                      unique_by=lambda r: (r[0], r[1]))


def brute(prices, reports):
    out = {}
    for s, d in prices:
        past = [r for r in reports if r[0] == s and r[1] <= d]
        best = max(past, key=lambda r: r[1]) if past else None
        out[(s, d)] = (best[2], best[3]) if best else (None, None)
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(prices=prices_st, reports=reports_st)
def test_asof_forms_match_brute_force(spark, prices, reports):
    p = spark.createDataFrame([(s, d, 1.0) for s, d in prices], "symbol string, trade_date date, close double")
    r = spark.createDataFrame(
        [(s, d, a, b, d, True) for s, d, a, b in reports],
        "symbol string, report_date date, pe_ratio double, debt_to_equity double, "
        "effective_date date, is_current boolean")
    want = brute(prices, reports)
    for df in (asof.asof_join(p, r), asof.asof_join(p, r, shuffle=True), asof.asof_join_union(p, r)):
        got = {(x.symbol, x.trade_date): (x.pe_ratio, x.debt_to_equity) for x in df.collect()}
        assert got == want
