"""Inline-fixture unit tests for the edge cases of the operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tradelens.functions import scalars as S
from tradelens.operators import asof as A
from tradelens.operators import clean as C
from tradelens.operators import ml as ML
from tradelens.operators.aggregate import policy_aggregate
from tradelens.operators.window import expanding_lagged_avg, fixed_size_batches

D = dt.date


def _prices(spark):
    return spark.createDataFrame(
        [("AAA", D(2024, 1, 2), 10.0), ("AAA", D(2024, 1, 5), 11.0), ("AAA", D(2024, 1, 9), 12.0),
         ("BBB", D(2024, 1, 3), 50.0)], "ticker string, date date, close double")


def test_asof_backward_cases(spark):
    left = spark.createDataFrame(
        [("k1", "AAA", D(2024, 1, 5)), ("k2", "AAA", D(2024, 1, 7)), ("k3", "BBB", D(2024, 1, 1)),
         ("k4", "ZZZ", D(2024, 1, 5)), ("k5", "AAA", D(2024, 1, 7))],
        "key string, ticker string, date date")
    out = A.asof_join(left, _prices(spark), by="ticker", left_on="date", right_on="date",
                      values=["close"], direction="backward")
    got = {r.key: r.close for r in out.collect()}
    assert got == {"k1": 11.0, "k2": 11.0, "k3": None, "k4": None, "k5": 11.0}


def test_asof_forward_cases(spark):
    left = spark.createDataFrame(
        [("k1", "AAA", D(2024, 1, 6)), ("k2", "AAA", D(2024, 1, 9)), ("k3", "AAA", D(2024, 1, 10))],
        "key string, ticker string, fd date")
    out = A.asof_join(left, _prices(spark), by="ticker", left_on="fd", right_on="date",
                      values=["close"], direction="forward")
    got = {r.key: r.close for r in out.collect()}
    assert got == {"k1": 12.0, "k2": 12.0, "k3": None}


def test_asof_null_payload_is_kept(spark):
    prices = spark.createDataFrame([("AAA", D(2024, 1, 1), 1.0), ("AAA", D(2024, 1, 2), None)],
                                   "ticker string, date date, close double")
    left = spark.createDataFrame([("AAA", D(2024, 1, 3))], "ticker string, date date")
    out = A.asof_join(left, prices, by="ticker", left_on="date", right_on="date",
                      values=["close"], left_unique=True)
    assert out.collect()[0].close is None


def test_expanding_lagged_avg(spark):
    day = S.DAY_MS
    df = spark.createDataFrame(
        [("A", 0 * day, 100000), ("A", 5 * day, 200000), ("A", 10 * day, None),
         ("A", 15 * day, 400000), ("B", 0, 100000)], "ticker string, timestamp long, e5 long")
    out = expanding_lagged_avg(df, value_e5="e5", delta_days=10)
    got = {(r.ticker, r.timestamp): r.avg_target_expanding for r in out.collect()}
    assert got[("A", 0)] is None and got[("A", 5 * day)] is None
    assert got[("A", 10 * day)] == 1.0 and got[("A", 15 * day)] == 1.5
    assert got[("B", 0)] is None


def test_daily_policy_agg_edge_cases(spark):
    rows = [("T", D(2024, 1, 1), None, "I", None, 1, "k1", 5.0),
            ("T", D(2024, 1, 1), None, "D", "c2", 2, "k2", 7.0),
            (None, D(2024, 1, 1), 3, "D", "c3", 3, "k3", 1.0)]
    df = spark.createDataFrame(rows, "ticker string, date date, shares int, ownership string, "
                                     "company_cik string, timestamp long, key string, price double")
    pol = {"shares": "sum", "ownership": "mode_first", "company_cik": "first", "price": "mean",
           "market_cap": "first"}
    out = policy_aggregate(df, pol).collect()
    assert len(out) == 1
    r = out[0]
    assert r.shares == 0 and r.ownership == "D" and r.company_cik == "c2" and r.price == 6.0
    assert "market_cap" not in out[0].asDict()


def test_boolean_mode_tie_is_false(spark):
    df = spark.createDataFrame([("T", D(2024, 1, 1), True), ("T", D(2024, 1, 1), False)],
                               "ticker string, date date, derivative boolean")
    assert policy_aggregate(df, {"derivative": "mode_first"}).collect()[0].derivative is False


def test_pct_change_and_fallback(spark):
    df = spark.createDataFrame([(0.0, 1.0, 0.0), (10.0, 11.0, 3.0)], "s double, e double, p double")
    out = df.select(S.pct_change("s", "e").alias("r"), S.price_fallback("p", "s").alias("p")).collect()
    assert out[0].r is None and out[0].p == 0.0
    assert out[1].r == 0.1 and out[1].p == 3.0


def test_cast_numeric_or_reject(spark):
    df = spark.createDataFrame([("10.5",), ("x",), ("3000000000",), (None,)], "shares string")
    out = C.cast_numeric_or_reject(df, {"shares": "int"}).collect()
    assert [r.shares for r in out] == [10]


def test_parse_date_with_suffix(spark):
    df = spark.createDataFrame([("2024-01-02-05:00",), ("bad",), (None,), ("2024-03-04",)], "d string")
    got = [r.x for r in df.select(S.parse_date_with_suffix("d").alias("x")).collect()]
    assert got == [D(2024, 1, 2), None, None, D(2024, 3, 4)]


def test_first_business_day(spark):
    df = spark.createDataFrame([(D(2024, 6, 15),), (D(2024, 9, 30),), (D(2024, 10, 9),)], "d date")
    got = [r.x for r in df.select(S.first_business_day("d").alias("x")).collect()]
    assert got == [D(2024, 6, 3), D(2024, 9, 2), D(2024, 10, 1)]


def test_owner_code_and_truthy(spark):
    df = spark.createDataFrame([("1", "true", None, "TRUE ")], "a string, b string, c string, d string")
    r = df.select(S.owner_code_bits("a", "b", "c", "d").alias("o")).collect()[0]
    assert r.o == "1101"


def test_null_sentinels_dropna(spark):
    df = spark.createDataFrame([("None", 1.0), ("---", 2.0), ("x", None)], "a string, pct_change double")
    out = C.dropna_subset(C.null_sentinels(df), ["pct_change", "avg_target_expanding"]).collect()
    assert [(r.a, r.pct_change) for r in out] == [(None, 1.0), (None, 2.0)]


def test_direction_assert_raises(spark):
    df = spark.createDataFrame([("D",), ("A",)], "acquired_disposed string")
    checked, _ = C.assert_all_equal(df, "acquired_disposed", "D", mode="raise")
    with pytest.raises(Exception):
        checked.collect()
    good, bad = C.assert_all_equal(df, "acquired_disposed", "D")
    assert good.count() == 1 and bad.count() == 1


def test_scale_continuous(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    out = ML.scale_continuous(df, ["x", "c"]).collect()
    assert sorted(r.x for r in out) == [-1.0, 1.0] and [r.c for r in out] == [0.0, 0.0]


def test_one_hot_drop_binary(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), ("a", "z")], "bin string, tri string")
    out = ML.one_hot_columns(df, ["bin", "tri"])
    assert sorted(out.columns) == ["bin_b", "tri_x", "tri_y", "tri_z"]


def test_backtest_shorts(spark):
    df = spark.createDataFrame([(-0.1, -0.05), (-0.2, 0.02)], "prediction double, label double")
    r = ML.backtest_shorts(df, threshold=0.0).collect()[0]
    assert abs(r.gains - 3.0) < 1e-12 and r.capital == 300.0


def test_fixed_size_batches_global(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    out = fixed_size_batches(df, size=100, order=["k"]).collect()
    assert all(r.batch == r.k // 100 for r in out)


def test_multiset_fingerprint(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "i int, s string")
    b = spark.createDataFrame([(2, "y"), (1, "x"), (1, "x")], "i int, s string")
    c = spark.createDataFrame([(2, "y"), (2, "y"), (1, "x")], "i int, s string")
    assert C.same_rows(a, b) and not C.same_rows(a, c)
    assert C.rows_aligned(a, b).count() == 0 and C.rows_aligned(a, c).count() == 2


def test_batches_by_key_with_hot_key(spark):
    # one key holds almost all rows: it is spread over several range
    # partitions and still numbered consecutively
    rows = [("HOT", i) for i in range(3000)] + [("COLD", i) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, o int")
    out = fixed_size_batches(df, size=250, order=["o"], by=["k"]).collect()
    assert all(r.batch == r.o // 250 for r in out) and len(out) == 3007


def test_asof_hot_ticker_many_rows_per_day(spark):
    left = spark.createDataFrame([(f"k{i}", "HOT", D(2024, 1, 1 + i % 9)) for i in range(2000)],
                                 "key string, ticker string, date date")
    out = A.asof_join(left, _prices(spark).where(F.col("ticker") == "AAA")
                      .withColumn("ticker", F.lit("HOT")),
                      by="ticker", left_on="date", right_on="date", values=["close"])
    got = {r.date: r.close for r in out.collect()}
    assert out.count() == 2000
    assert got[D(2024, 1, 1)] is None and got[D(2024, 1, 4)] == 10.0 and got[D(2024, 1, 9)] == 12.0


def test_prefix_sum_lagged_mean_matches_window(spark):
    from tradelens.operators.window import lagged_mean_by_prefix_sums
    day = S.DAY_MS
    rows = [("HOT", (i % 40) * day + (i % 3), i % 7 if i % 11 else None) for i in range(3000)] + \
           [("A", 0, 1), ("A", 5 * day, 2), ("A", 10 * day, None), ("A", 15 * day, 4), ("B", 0, 1)]
    df = spark.createDataFrame(rows, "ticker string, timestamp long, e5 long")
    a = {(r.ticker, r.timestamp, r.e5, r.avg_target_expanding) for r in
         expanding_lagged_avg(df, value_e5="e5", delta_days=10).collect()}
    got = lagged_mean_by_prefix_sums(df, value="e5", delta_days=10, scale=100000.0).collect()
    b = {(r.ticker, r.timestamp, r.e5, r.avg_target_expanding) for r in got}
    assert len(got) == len(rows) and a == b
