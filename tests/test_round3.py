"""What grows with the tables: landed texts, shuffle partitions, passes over the target."""

import datetime as dt
import os
from contextlib import nullcontext

from pyspark.sql import functions as F

from tradelens.plans import filing_docs as FD
from tradelens.plans import q_ml
from tradelens.session import partitions_for, stored
from tradelens.sources.catalog import FeatureStore, load_catalog
from tradelens.sources.filings import pack_filings, read_filing_records

KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def _files(path, end):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(end)]


def test_packed_filings_are_compressed_and_bounded(spark, tmp, monkeypatch):
    monkeypatch.setattr("tradelens.sources.filings.RECORDS_PER_FILE", 50)
    rows = [(f"p/{i}.txt", "<value>é</value>\n" * 300 + str(i)) for i in range(200)]
    texts = spark.createDataFrame(rows, "file_path string, raw string").coalesce(1)
    pack_filings(texts, tmp + "/packed")
    files = _files(tmp + "/packed", ".gz")
    assert len(files) == 4
    assert sum(map(os.path.getsize, files)) < sum(len(r) for _, r in rows) / 10
    assert sorted(map(tuple, read_filing_records(spark, tmp + "/packed").collect())) == sorted(rows)


def _orders(spark, at):
    day = dt.datetime(2000, 1, 2)
    spark.createDataFrame(
        [(1, 5, "O", "1-URGENT", day), (2, 6, "F", "2-HIGH", day), (2, 6, "F", "2-HIGH", day),
         (None, 7, "P", "3-MEDIUM", day), (3, 8, "P", None, day)],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, "
        "o_orderdate timestamp").write.parquet(at + "/orders.parquet")
    line = [(1, 2, "O", "R", day, 0.07, 3.0, 9.5, 0.05), (1, 2, "O", "A", day, 0.0, 2.0, 1.25, 0.0),
            (1, 1, "F", "N", day, 0.0, 1.0, 2.0, 0.0), (2, 1, "F", "N", day, None, 1.0, 2.0, 0.0),
            (2, None, "F", None, day, 0.0, 1.0, 2.0, 0.0), (None, 1, "F", "N", day, 0.0, 1.0, 2.0, 0.0)]
    spark.createDataFrame(line, "l_orderkey long, l_linenumber int, l_linestatus string, "
                          "l_returnflag string, l_shipdate timestamp, l_tax double, l_quantity double, "
                          "l_extendedprice double, l_discount double").write.parquet(
        at + "/lineitem.parquet")


def test_texts_are_built_behind_the_shuffles_and_landed_compressed(spark, tmp, monkeypatch):
    _orders(spark, tmp)
    monkeypatch.setattr(FD, "LINES_PER_PARTITION", 1)
    texts = FD.filing_texts(spark, tmp)
    plan = texts._jdf.queryExecution().optimizedPlan().toString()
    assert "<transactionCoding>" in plan.split("Join")[0]       # the top of the plan
    assert "<transactionCoding>" not in plan.split("Join")[1]
    got = texts.where("file_path like '%/1.txt'").first().raw
    # by table, line number and text; the derivative table follows
    assert got.index("<value>2.00</value>") < got.index("<value>1.25</value>") < got.index("<value>9.50</value>")
    assert texts.count() == 5
    landed = FD._landed(spark, tmp)
    assert landed.count() == 5
    at = FD._place(spark, tmp, "landed-filings")
    assert _files(at, ".zstd.parquet")


def test_shuffle_partitions_follow_the_rows(spark):
    before = spark.conf.get(KEY, None)
    with partitions_for(spark, 10_000_000):
        assert int(spark.conf.get(KEY)) == 50
        with partitions_for(spark, 1):
            assert int(spark.conf.get(KEY)) == 50
        with partitions_for(spark, 10_000_000, 20_000):
            assert int(spark.conf.get(KEY)) == 500
    assert spark.conf.get(KEY, None) == before


def test_upsert_sets_partitions_by_the_width_of_a_tables_rows(spark, tmp, monkeypatch):
    store = FeatureStore(spark, tmp, load_catalog({"t": {
        "primary_key": ["k"], "event_time": "e", "rows_per_bucket": 10}}, 1))
    seen = []
    real = FeatureStore._write
    monkeypatch.setattr(FeatureStore, "_write", lambda self, *a: (
        seen.append(int(spark.conf.get(KEY))), real(self, *a))[1])
    store.upsert("t", spark.range(400).select(F.col("id").alias("k"), F.col("id").alias("e")))
    assert seen == [40] and store.read("t").count() == 400
    assert _files(tmp, ".zstd.parquet")


def _once(spark, monkeypatch, query, rows, schema):
    """How often the target's rows are built for a query."""
    built = spark.sparkContext.accumulator(0)

    def note(r):
        built.add(1)
        return r
    target = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).map(note), schema)
    monkeypatch.setattr(q_ml, "rt4", lambda *a: target)
    monkeypatch.setattr(q_ml, "_partitions", lambda *a: nullcontext())
    built.value = 0
    out = query(spark, "").collect()
    assert built.value == len(rows)
    return out


def test_target_is_built_once_for_encoding_and_fit(spark, monkeypatch):
    cats = [("a", "O", True, "0100"), ("b", "F", False, "0000"), ("c", "O", False, "0100")]
    got = _once(spark, monkeypatch, q_ml.q_one_hot_drop_binary, cats,
                "key string, coding string, derivative boolean, owner_code string")
    assert sorted(map(tuple, got)) == [("a", 1.0, 1.0, 1.0), ("b", 0.0, 0.0, 0.0), ("c", 1.0, 0.0, 1.0)]
    got = _once(spark, monkeypatch, q_ml.q_encode_categories, cats,
                "key string, coding string, derivative boolean, owner_code string")
    assert sorted(map(tuple, got)) == [("a", 1.0, 1.0), ("b", 0.0, 0.0), ("c", 1.0, 1.0)]
    got = _once(spark, monkeypatch, q_ml.q_train_regressor_ols,
                [(1.0, 1.0), (3.0, 2.0), (5.0, 3.0)], "pct_change double, avg_target_expanding double")
    assert tuple(got[0]) == (2.0, -1.0, 3)


def test_stored_rows_are_compressed_and_whole(spark):
    df = spark.range(50).select("id", F.array(F.lit("é"), F.lit(None)).alias("a"))
    back = stored(df)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert all(f.endswith(".zstd.parquet") for f in back.inputFiles())
