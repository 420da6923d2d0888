"""Digits, nulls, folders and time limits that must not be lost silently."""

import datetime as dt
import os
import re
import types

import pytest
from pyspark.sql import functions as F

from tradelens import session
from tradelens.operators import clean as C
from tradelens.operators.aggregate import policy_aggregate
from tradelens.operators.window import expanding_lagged_avg, fixed_size_batches, \
    lagged_mean_by_prefix_sums
from tradelens.sources import topics as TP
from tradelens.sources.catalog import FeatureStore, load_catalog, load_catalog_yaml
from tradelens.sources.filings import read_filing_files
from tradelens.sources.html import page_links
from tradelens.sources.tables import input_stamp
from tradelens.streaming import streams as ST


def test_mean_keeps_sub_cent_prices(spark):
    df = spark.createDataFrame([("A", 1, 0.0049), ("A", 1, 12.3456), ("B", 1, 0.004), ("C", 1, None)],
                               "ticker string, date int, price double")
    got = {r.ticker: r.price for r in policy_aggregate(df, {"price": "mean"}).collect()}
    assert got == {"A": 6.17525, "B": 0.004, "C": None}


def test_target_keeps_sub_cent_prices(spark):
    from tradelens.plans.target import build_training_target
    day, ms = dt.date(2024, 1, 1), 1704067200000
    tx = spark.createDataFrame(
        [(f"k{i}", "A", day + dt.timedelta(d), ms + d * 86400000, 100, 0.004, "R") for i, d in
         enumerate((0, 40))], "key string, ticker string, date date, timestamp long, shares int, "
        "price double, acquired_disposed string")
    bars = spark.createDataFrame([("A", day + dt.timedelta(d), 30.0 + d) for d in range(90)],
                                 "ticker string, date date, close double")
    (r,) = build_training_target(tx, bars).collect()
    assert r.price == 0.004 and r.tx_value == 100 * 0.004


def test_bigint_cast_is_exact(spark):
    df = spark.createDataFrame([("9007199254740993",), ("1234567890123456789",), ("10.7",), ("x",),
                                (" -3 ",), ("9223372036854775808",), (None,)], "v string")
    got = [r.v for r in C.cast_numeric_or_reject(df, {"v": "bigint"}).collect()]
    assert got == [9007199254740993, 1234567890123456789, 10, -3]


def test_clean_transactions(spark):
    rows = [(" a ", "1.0", "5", "true", "2024-01-02-05:00"), (" a ", "1.0", "5", "true", "2024-01-02-05:00"),
            ("b", "x", "5", "0", "2024-01-02"), ("None", "1", "5", "0", "2024-01-02"),
            ("c", "2", "7", "no", "bad"), ("d", "2", None, "1", "2024-01-02")]
    df = spark.createDataFrame(rows, "ticker string, price string, shares string, equity_swap string, "
                                     "date string")
    got = [tuple(r) for r in C.clean_transactions(df).collect()]
    assert got == [("A", 1.0, 5, True, dt.date(2024, 1, 2))]


def test_batches_keep_null_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "g string, v int")
    got = sorted((r.g or "", r.v, r.batch) for r in fixed_size_batches(
        df, size=1, order=["v"], by=["g"]).collect())
    assert got == [("", 3, 0), ("", 4, 1), ("a", 1, 0), ("a", 2, 1)]


def test_prefix_sums_with_null_keys_and_one_hot_time(spark):
    day = 86400000
    rows = [("hot", 0, i) for i in range(900)] + [("hot", 40 * day, 7), (None, 0, 5), (None, 40 * day, 6)]
    df = spark.createDataFrame(rows, "ticker string, timestamp long, v long")
    a = lagged_mean_by_prefix_sums(df, value="v", delta_days=30, scale=100000.0)
    b = expanding_lagged_avg(df, value_e5="v", delta_days=30)
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.select(a.columns).collect()))


def test_run_live_raises_on_timeout(spark, tmp):
    src = os.path.join(tmp, "in")
    spark.range(3).write.parquet(src)
    stream = TP.read_topic_stream(spark, path=src, schema=spark.read.parquet(src).schema)
    with pytest.raises(TimeoutError):
        ST.run_live(stream, ST.batch_sink(os.path.join(tmp, "out")), os.path.join(tmp, "ckpt"),
                    interval="1 second", iterations=50, timeout_s=4)


def test_landed_files_follow_the_shuffle_partitions(spark, tmp):
    ST.land(spark.range(1000).withColumn("k", F.lit(1)), os.path.join(tmp, "in"))
    assert ST.files_per_batch(spark, os.path.join(tmp, "in"), 1) == 8
    assert spark.read.parquet(os.path.join(tmp, "in")).rdd.getNumPartitions() >= 4


def test_no_private_folder_on_a_cluster(monkeypatch):
    conf = types.SimpleNamespace(get=lambda k, d=None: d)
    for master in ("spark://h:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        fake = types.SimpleNamespace(conf=conf, sparkContext=types.SimpleNamespace(master=master))
        with pytest.raises(ValueError):
            session.checkpoint_dir(fake)


DAY = dt.date(2024, 1, 1)


def parquet_files(top):
    return {os.path.join(d, f) for d, _, fs in os.walk(top) for f in fs if f.endswith(".parquet")}


def test_small_batch_rewrites_a_small_part(spark, tmp):
    """1 % of the keys, all recent: well under half of the files change."""
    fs = FeatureStore(spark, tmp, load_catalog({"p": {
        "primary_key": ["ticker", "date"], "event_time": "date", "buckets": 4}}, 1))
    rows = [(f"T{t}", DAY + dt.timedelta(d), float(t + d)) for t in range(20) for d in range(300)]
    schema = "ticker string, date date, close double"
    fs.upsert("p", spark.createDataFrame(rows, schema))
    before = parquet_files(os.path.join(tmp, "p_v1", "data"))
    new = [(t, d, c + 1) for t, d, c in rows if d >= DAY + dt.timedelta(297)]
    fs.upsert("p", spark.createDataFrame(new, schema))
    after = parquet_files(os.path.join(tmp, "p_v1", "data"))
    assert len(before - after) <= 0.2 * len(before)
    got = {(r.ticker, r.date): r.close for r in fs.read("p").collect()}
    assert got == {(t, d): c for t, d, c in rows} | {(t, d): c for t, d, c in new}


def test_buckets_follow_the_first_batch(spark, tmp):
    fs = FeatureStore(spark, tmp, load_catalog({"t": {
        "primary_key": ["k"], "event_time": "d", "rows_per_bucket": 10}}, 1))
    fs.upsert("t", spark.range(95).select(F.col("id").alias("k"), F.lit(DAY).alias("d")))
    names = {m[0] for f in parquet_files(os.path.join(tmp, "t_v1", "data"))
             if (m := re.search(r"bucket=\d+", f))}
    assert 8 <= len(names) <= 10


def test_an_outgrown_bucket_is_split(spark, tmp):
    fs = FeatureStore(spark, tmp, load_catalog({"t": {
        "primary_key": ["k"], "event_time": "d", "rows_per_bucket": 100}}, 1))
    for n in (50, 3000):
        fs.upsert("t", spark.range(n).select(F.col("id").alias("k"), F.lit(DAY).alias("d")))
    m = fs.manifest("t")
    assert m.buckets == {"all": 31} and len(m.slots) == 31
    assert max(s.rows for s in m.slots.values()) < 300
    assert sorted(r.k for r in fs.read("t").collect()) == list(range(3000))


@pytest.mark.parametrize("conflict,kept", [(None, "correction"), ("event_time", "first")])
def test_conflict_rules(spark, tmp, conflict, kept):
    spec = {"primary_key": ["k"], "event_time": "d"} | ({"conflict": conflict} if conflict else {})
    fs = FeatureStore(spark, tmp, load_catalog({"t": spec}, 1))
    schema = "k int, d date, v string"
    fs.upsert("t", spark.createDataFrame([(5, DAY, "first"), (6, DAY, "other")], schema))
    fs.upsert("t", spark.createDataFrame([(5, DAY - dt.timedelta(9), "correction")], schema))
    assert {r.k: r.v for r in fs.read("t").collect()} == {5: kept, 6: "other"}


def test_yaml_catalog(tmp):
    pytest.importorskip("yaml")
    path = os.path.join(tmp, "groups.yaml")
    with open(path, "w") as fh:
        fh.write("p:\n  primary_key: [ticker, date]\n  event_time: date\n")
    spec = load_catalog_yaml(path, 3)["p"]
    assert (spec.name, spec.version, spec.primary_key) == ("p", 3, ("ticker", "date"))


def test_page_links_take_anchors_and_a_suffix(spark):
    html = ("<link href=\"/Archives/style.txt\"><a class='x' href='/Archives/a/1.txt'>1</a>"
            "<A HREF=\"/Archives/b/2.txt\">2</A><a href=\"/c/3.htm\">3</a>")
    df = spark.createDataFrame([(html,)], "html string")
    assert {r.link for r in page_links(df, suffix=".txt").collect()} == {"a/1.txt", "b/2.txt"}


def test_filing_files_below_a_root_with_special_characters(spark, tmp):
    root = os.path.join(tmp, "a+b (c)")
    os.makedirs(os.path.join(root, "edgar"))
    with open(os.path.join(root, "edgar", "1.txt"), "w") as fh:
        fh.write("text")
    rows = read_filing_files(spark, os.path.join(root, "edgar")).collect()
    assert rows[0].raw == "text"


def test_input_stamp_follows_the_files(spark, tmp):
    path = os.path.join(tmp, "t.parquet")
    spark.range(3).write.parquet(path)
    a = input_stamp(spark, path)
    assert a == input_stamp(spark, path)
    spark.range(4).write.mode("append").parquet(path)
    assert a != input_stamp(spark, path)
