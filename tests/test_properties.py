"""Randomised checks against brute-force restatements of the documented
semantics (as-of joins, lagged expanding mean, keyed upsert)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tradelens.functions import scalars as S
from tradelens.operators import asof as A
from tradelens.operators.window import expanding_lagged_avg, lagged_mean_by_prefix_sums
from tradelens.sources.catalog import TableSpec, merge_upsert

BASE = dt.date(2024, 1, 1)


def _key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

tickers = st.sampled_from(["A", "B", "C"])
days = st.integers(min_value=0, max_value=30)


@SETTINGS
@given(prices=st.dictionaries(st.tuples(tickers, days), st.integers(1, 500), max_size=25),
       left=st.lists(st.tuples(tickers, days), min_size=1, max_size=25))
def test_asof_matches_brute_force(spark, prices, left):
    p = spark.createDataFrame([(t, BASE + dt.timedelta(d), float(c)) for (t, d), c in prices.items()],
                              "ticker string, date date, close double")
    rows = [(f"k{i}", t, BASE + dt.timedelta(d)) for i, (t, d) in enumerate(left)]
    lf = spark.createDataFrame(rows, "key string, ticker string, date date")
    back = {r.key: r.close for r in A.asof_join(lf, p, by="ticker", left_on="date",
                                                right_on="date", values=["close"]).collect()}
    fwd = {r.key: r.close for r in A.asof_join(lf, p, by="ticker", left_on="date", right_on="date",
                                               values=["close"], direction="forward").collect()}
    for k, t, d in rows:
        earlier = [(pd, c) for (pt, pd), c in prices.items() if pt == t and BASE + dt.timedelta(pd) <= d]
        later = [(pd, c) for (pt, pd), c in prices.items() if pt == t and BASE + dt.timedelta(pd) >= d]
        assert back[k] == (float(max(earlier)[1]) if earlier else None)
        assert fwd[k] == (float(min(later)[1]) if later else None)


@SETTINGS
@given(rows=st.lists(st.tuples(tickers, st.integers(0, 60), st.one_of(st.none(), st.integers(-9, 9))),
                     min_size=1, max_size=40),
       delta=st.integers(0, 20))
def test_lagged_mean_matches_brute_force(spark, rows, delta):
    day = S.DAY_MS
    data = [(t, d * day, v) for t, d, v in rows]
    df = spark.createDataFrame(data, "ticker string, timestamp long, e5 long")
    win = sorted(((r.ticker, r.timestamp, r.e5, r.m) for r in expanding_lagged_avg(
        df, value_e5="e5", delta_days=delta, out="m").collect()), key=_key)
    pre = sorted(((r.ticker, r.timestamp, r.e5, r.m) for r in lagged_mean_by_prefix_sums(
        df, value="e5", delta_days=delta, scale=100000.0, out="m").collect()), key=_key)
    expect = []
    for t, ts, v in data:
        vals = [x for tt, tts, x in data if tt == t and tts <= ts - delta * day and x is not None]
        # never look at a label newer than the cut-off
        expect.append((t, ts, v, (sum(vals) / (len(vals) * 100000.0)) if vals else None))
    expect = sorted(expect, key=_key)
    assert win == expect and pre == expect


@SETTINGS
@given(batches=st.lists(st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 5),
                                           st.integers(0, 99)), min_size=1, max_size=8),
                        min_size=1, max_size=4))
def test_upsert_last_batch_wins_and_replay_is_idempotent(spark, batches):
    spec = TableSpec("t", 1, ("k",), "d")
    table = None
    state = {}
    for i, b in enumerate(batches):
        # one row per key inside a batch (the latest of that batch)
        dedup = {}
        for k, d, v in b:
            if k not in dedup or (d, v) > dedup[k]:
                dedup[k] = (d, v)
        df = spark.createDataFrame([(k, BASE + dt.timedelta(d), v) for k, (d, v) in dedup.items()],
                                   "k string, d date, v int")
        table = merge_upsert(table, df, spec, i)
        replay = merge_upsert(table, df, spec, i)
        for k, (d, v) in dedup.items():
            state[k] = (d, v)      # the last batch overwrites
        got = {r.k: (r.d, r.v) for r in table.collect()}
        assert got == {k: (BASE + dt.timedelta(d), v) for k, (d, v) in state.items()}
        assert sorted(map(tuple, replay.collect())) == sorted(map(tuple, table.collect()))
        table = spark.createDataFrame(table.collect(), table.schema)  # keep plans small
