"""Large jobs go through their rows in parts, each with its own shuffles, which go with it."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tradelens import session
from tradelens.plans import target as TG
from tradelens.session import stored
from tradelens.sources import catalog
from tradelens.sources.catalog import FeatureStore, load_catalog

DAY = dt.date(2024, 1, 1)


def shuffles(spark):
    """Bytes of the shuffle files on disk, by shuffle."""
    out = {}
    for top in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs():
        for d, _, names in os.walk(top.getPath()):
            for n in names:
                if n.startswith("shuffle_"):
                    k = n.split("_")[1]
                    out[k] = out.get(k, 0) + os.lstat(os.path.join(d, n)).st_size
    return out


def left(spark, before):
    return sum(v for k, v in shuffles(spark).items() if k not in before)


def market(spark):
    """Transactions and bars of seven tickers, one of them without a bar on the last days."""
    tx = spark.range(700).select(
        F.concat(F.lit(" t"), F.col("id") % 7, F.lit(" ")).alias("ticker"),
        F.date_add(F.lit(DAY), (F.col("id") / 7).cast("int")).alias("date"),
        F.concat(F.lit("k"), F.col("id")).alias("key"), F.lit("R").alias("acquired_disposed"),
        (F.col("id") % 13).cast("int").alias("shares"), (F.col("id") % 5 + 1.0).alias("price")
    ).withColumn("timestamp", F.unix_date("date").cast("bigint") * 86400000)
    bars = tx.select(F.upper(F.trim("ticker")).alias("ticker"), "date",
                     (F.col("shares") + 1.0).alias("close"))
    return tx, bars.where("ticker <> 'T3' or date < '2024-03-01'")


def table(spark, tmp, **options):
    return FeatureStore(spark, tmp, load_catalog({"t": {
        "primary_key": ["k"], "event_time": "d", "stable_event_time": True, **options}}, 1))


def batch(spark, n, per_key=1):
    return spark.range(n).select((F.col("id") / per_key).cast("long").alias("k"),
                                 F.date_add(F.lit(DAY), (F.col("id") % 90).cast("int")).alias("d"),
                                 F.sha2(F.col("id").cast("string"), 256).alias("v"))


def test_shuffles_go_with_the_action_that_stored_its_rows(spark, tmp):
    before = shuffles(spark)
    rows = spark.range(20000).withColumn("v", F.sha2(F.col("id").cast("string"), 256)).repartition(7)
    assert stored(rows).count() == 20000
    assert session.cut_lineage(rows.repartition(5)).count() == 20000
    table(spark, tmp).upsert("t", batch(spark, 20000).repartition(3))
    assert left(spark, before) < 100_000


def test_target_in_parts_is_the_target(spark):
    tx, bars = market(spark)
    whole = TG.build_training_target(tx, bars)
    parts = list(TG.training_target_in_parts(tx, bars, 3, period=30))
    got = [[tuple(r) for r in p.select(*whole.columns).collect()] for p in parts]
    assert len(parts) == 3 and sum(map(bool, got)) > 1
    assert sorted(r for p in got for r in p) == sorted(map(tuple, whole.collect()))
    target = whole.select("ticker", "date", "key", "avg_target_expanding")
    want = TG.build_inference_features(tx, target, direction="R")
    some = TG.inference_features_in_parts(tx, target, 3, direction="R")
    assert sorted(tuple(r) for p in some for r in p.select(*want.columns).collect()) == sorted(
        map(tuple, want.collect()))


@pytest.mark.parametrize("per_key", (1, 2, 200))
def test_a_write_in_groups_of_periods_keeps_the_rows_of_a_write_at_once(spark, tmp, per_key, monkeypatch):
    rows, more = batch(spark, 900, per_key), batch(spark, 300).withColumn("v", F.lit("new"))
    once, grouped = table(spark, os.path.join(tmp, "a")), table(
        spark, os.path.join(tmp, "b"), rows_per_bucket=100)
    for b in (rows, more):
        once.upsert("t", b)
    monkeypatch.setattr(catalog, "LOOK", 1)
    monkeypatch.setattr(catalog, "GROUP", 1)
    for b in ([rows.where("k % 2 = 0"), rows.where("k % 2 = 1")], more):
        grouped.upsert("t", b)

    def read(fs):
        return sorted(map(tuple, fs.read("t").collect()))
    if per_key > 1:     # its days decide, and one day has several rows of a key: compare the keys
        assert sorted(r[0] for r in read(once)) == sorted(r[0] for r in read(grouped))
    else:
        assert read(once) == read(grouped) and len(read(once)) == 900


def test_landed_rows_are_not_copied(spark, tmp, monkeypatch):
    rows = stored(batch(spark, 500))
    monkeypatch.setattr(FeatureStore, "_land", lambda *a: 1 / 0)
    fs = table(spark, tmp)
    assert fs.upsert("t", rows, landed=True) == 0
    assert sorted(map(tuple, fs.read("t").collect())) == sorted(map(tuple, rows.collect()))


def test_parse_stream_takes_its_texts_in_groups_of_months(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver tables not present")
    from tradelens.plans import q_stream
    monkeypatch.setattr(catalog, "LOOK", 1)
    monkeypatch.setattr(catalog, "GROUP", 0)
    whole = q_stream.q_stream_parse_filings(spark, sf)
    asked = []
    lookup = FeatureStore.lookup
    monkeypatch.setattr(FeatureStore, "lookup", lambda self, ref, keys: asked.append(ref) or lookup(
        self, ref, keys))
    monkeypatch.setattr(q_stream, "TEXTS_PER_LOOKUP", 20)
    grouped = q_stream.q_stream_parse_filings(spark, sf)
    assert len(asked) > 4
    assert sorted(map(tuple, grouped.collect())) == sorted(map(tuple, whole.collect()))


def test_refresh_in_parts_is_the_target(spark, tmp, monkeypatch):
    from tradelens.plans import refresh as RF
    tx, bars = market(spark)
    store = FeatureStore(spark, tmp, load_catalog(RF.REFRESH_CATALOG, 1))
    monkeypatch.setattr(session, "ROWS_PER_PART", 250)
    written = []
    monkeypatch.setattr(RF, "write_parts", lambda parts, path: session.write_parts(
        (written.append(path) or p for p in parts), path))
    for part in ("date < '2024-03-10'", "date >= '2024-03-10'"):
        store.upsert("bt4", tx.where(part), landed=True)
        store.upsert("p", bars.where(part))
        RF.refresh_training(store, direction="R")
    want = TG.build_training_target(tx, bars)
    assert len(written) > 4 and not any(os.path.isdir(p.removeprefix("file:")) for p in written)
    assert sorted(map(tuple, store.read("rt4").select(*want.columns).collect())) == sorted(
        map(tuple, want.collect()))


def test_vectors_of_the_searches_are_stored_compressed(spark, monkeypatch):
    from tradelens.operators import ml, search
    kept = []
    for m in (ml, search):
        monkeypatch.setattr(m, "stored", lambda df: kept.append(stored(df)) or kept[-1])
    rows = spark.range(400).select(F.col("id").cast("string").alias("key"), (F.col("id") % 7 + 0.5).alias("x"),
                                   F.col("id").cast("double").alias("y"))
    ml.search_regressors(rows, features=["x"], target="y", families=("linear",))
    search.search_within(rows, features=["x"], target="y", key="key", budget_s=0, families=("linear",))
    assert len(kept) == 2 and all(f.endswith(".zstd.parquet") for k in kept for f in k.inputFiles())


def test_numbers_are_cast_without_a_detour_by_text(spark):
    from tradelens.operators import clean as C
    rows = spark.sql("select stack(6, 5.9D, double('NaN'), 3e9D, -5.9D, null, double('Infinity')) as d")
    both = C.cast_numeric_or_reject(rows.withColumn("b", F.col("d")), {"d": "int", "b": "bigint"})
    assert sorted(map(tuple, both.collect())) == [(-5, -5), (5, 5)]
    assert "as string" not in both._jdf.queryExecution().optimizedPlan().toString().lower()
    longs = spark.sql("select stack(3, 7L, 3000000000L, -3000000000L) as d")
    assert [r.d for r in C.cast_numeric_or_reject(longs, {"d": "int"}).collect()] == [7]
    assert C.cast_numeric_or_reject(longs, {"d": "bigint"}).count() == 3
