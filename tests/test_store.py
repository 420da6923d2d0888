"""The keyed store: no death loses rows, growth rewrites little, readers see whole versions."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tradelens.sources import catalog
from tradelens.sources.catalog import COMPACT, FeatureStore, load_catalog
from tradelens.sources.manifest import Manifest, TableStateError, address, power, split_source

DAY = dt.date(2024, 1, 1)
SCHEMA = "k long, d date, v string"


def store(spark, root, **options):
    return FeatureStore(spark, root, load_catalog({"t": {
        "primary_key": ["k"], "event_time": "d", **options}}, 1))


def rows_of(fs):
    return {r.k: r.v for r in fs.read("t").collect()}


def batch(spark, rows):
    return spark.createDataFrame([(k, DAY, v) for k, v in rows.items()], SCHEMA)


class Died(Exception):
    pass


STEPS = ["_land", "_plan", "_write", "commit", "after commit", "inside write"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("first", [True, False])
def test_a_death_at_any_step_loses_nothing(spark, tmp, monkeypatch, step, first):
    fs = store(spark, tmp, rows_per_bucket=5)
    old = {} if first else {k: "old" for k in range(10)}
    if old:
        fs.upsert("t", batch(spark, old))
    new = {k: "new" for k in range(8, 30)}

    with monkeypatch.context() as m:
        if step == "commit":
            # the empty first manifest is written, the one with rows is not
            real = catalog.commit
            m.setattr(catalog, "commit", lambda s, at, x: real(s, at, x) if not x.slots
                      else (_ for _ in ()).throw(Died()))
        elif step == "after commit":
            m.setattr(catalog, "remove_path", lambda *a: (_ for _ in ()).throw(Died()))
        elif step == "inside write":
            # some tasks of the write have put their files, the job has not ended
            def broken(self, spec, x, frame, plan, bid):
                bad = F.udf(lambda k: 1 // (k - 20) and k, "long")
                return FeatureStore._whole_write(self, spec, x, frame.withColumn("k", bad("k")),
                                                 plan, bid)
            m.setattr(FeatureStore, "_whole_write", FeatureStore._write, raising=False)
            m.setattr(FeatureStore, "_write", broken)
        else:
            m.setattr(FeatureStore, step, lambda *a, **b: (_ for _ in ()).throw(Died()))
        with pytest.raises(Exception) as e:
            fs.upsert("t", batch(spark, new))
        assert isinstance(e.value, Died) or "ZeroDivisionError" in str(e.value)

    again = store(spark, tmp, rows_per_bucket=5)       # another process
    whole = {**old, **new}
    seen = {r.k: r.v for r in again.read_or_empty("t", SCHEMA).collect()}
    assert seen == (whole if step == "after commit" else old)
    # an unrelated batch, then the dead one again, then what nobody needs goes
    again.upsert("t", batch(spark, {100: "other"}))
    assert rows_of(again) == {**seen, 100: "other"}
    again.upsert("t", batch(spark, new))
    again.vacuum("t")
    assert rows_of(again) == {**whole, 100: "other"}
    assert not [n for n in os.listdir(os.path.join(tmp, "t_v1")) if n.startswith("_work")]


def test_lost_or_damaged_state_is_an_error(spark, tmp):
    fs = store(spark, tmp)
    fs.upsert("t", batch(spark, {1: "a"}))
    folder = os.path.join(tmp, "t_v1", "manifests")
    newest = max(n for n in os.listdir(folder) if n.endswith(".json"))
    path = os.path.join(folder, newest)
    whole = open(path).read()
    for broken in (whole[:-20], whole.replace('"all"', '"alz"')):
        for name in os.listdir(folder):
            if name.endswith(".crc"):
                os.remove(os.path.join(folder, name))
        with open(path, "w") as fh:
            fh.write(broken)
        with pytest.raises(TableStateError):
            fs.read_or_empty("t", SCHEMA)
    for name in os.listdir(folder):
        os.remove(os.path.join(folder, name))
    for call in (lambda: fs.read_or_empty("t", SCHEMA), lambda: fs.upsert("t", batch(spark, {2: "b"}))):
        with pytest.raises(TableStateError):
            call()


def test_a_second_writer_fails_at_its_commit(spark, tmp, monkeypatch):
    fs = store(spark, tmp)
    fs.upsert("t", batch(spark, {1: "a"}))
    real = FeatureStore._write

    def slow(self, *a):
        done = real(self, *a)
        monkeypatch.setattr(FeatureStore, "_write", real)
        store(spark, tmp).upsert("t", batch(spark, {2: "quick"}))
        return done

    monkeypatch.setattr(FeatureStore, "_write", slow)
    with pytest.raises(TableStateError):
        fs.upsert("t", batch(spark, {2: "slow", 3: "slow"}))
    assert rows_of(fs) == {1: "a", 2: "quick"}


def test_a_reader_keeps_its_version(spark, tmp):
    fs = store(spark, tmp)
    fs.upsert("t", batch(spark, {1: "a", 2: "a"}))
    frame = fs.read("t")
    fs.upsert("t", batch(spark, {2: "b", 3: "b"}))
    fs.compact("t")
    assert {r.k: r.v for r in frame.collect()} == {1: "a", 2: "a"}
    assert rows_of(fs) == {1: "a", 2: "b", 3: "b"}


def test_growth_from_ten_rows(spark, tmp):
    """A table of 10 rows grows a hundredfold; later batches of 1 % random keys read and
    write no more than the stated share of it, and it stays equal to a dictionary."""
    rng = random.Random(1)
    fs = store(spark, tmp, rows_per_bucket=20)
    want = {k: "first" for k in range(10)}
    fs.upsert("t", batch(spark, want))
    sizes = [30, 100, 300, 700] + [10] * 12
    moved, credit = [], 0
    for i, n in enumerate(sizes):
        before = fs.manifest("t")
        new = {rng.randrange(1000): f"b{i}" for _ in range(n)}
        fs.upsert("t", batch(spark, new))
        want |= new
        after = fs.manifest("t")
        gone = {f.path for f in before.folders} - {f.path for f in after.folders}
        came = {f.path for f in after.folders} - {f.path for f in before.folders}
        read = sum(f.rows for f in before.folders if f.path in gone)
        written = sum(f.rows for f in after.folders if f.path in came)
        moved.append((len(new), read, written, max(s.rows for s in after.slots.values())))
        assert sum(after.buckets.values()) >= sum(s.rows for s in after.slots.values()) / 20 - 1
    for n, read, written, biggest in moved[4:]:
        # the credit of one batch, what was left of the last, and one bucket
        assert read <= 2 * COMPACT * n + 2 * biggest and written <= read + n
    total = sum(n for n, *_ in moved)
    assert sum(r for _, r, *_ in moved) <= (COMPACT + 1) * total
    assert rows_of(fs) == want
    fs.compact("t")
    assert not any(s.deltas for s in fs.manifest("t").slots.values())
    assert rows_of(fs) == want


def test_a_hundred_small_batches_do_not_pile_up(spark, tmp, monkeypatch):
    monkeypatch.setattr(catalog, "MAX_DELTAS", 4)
    fs = store(spark, tmp)
    fs.upsert("t", batch(spark, {k: "a" for k in range(50)}))
    for i in range(9):
        fs.upsert("t", batch(spark, {i: f"b{i}"}))
        assert max(len(s.deltas) for s in fs.manifest("t").slots.values()) <= 4
    assert rows_of(fs) == {**{k: "a" for k in range(50)}, **{i: f"b{i}" for i in range(9)}}


def test_changes_since_a_batch(spark, tmp):
    fs = store(spark, tmp)
    fs.upsert("t", batch(spark, {k: "a" for k in range(20)}), 5)
    fs.upsert("t", batch(spark, {1: "b", 50: "b"}), 6)
    fs.upsert("t", batch(spark, {1: "c"}), 7)
    assert {r.k: (r.v, r._batch) for r in fs.changes("t", 5).collect()} == {1: ("c", 7), 50: ("b", 6)}
    assert fs.changes("t", 7).count() == 0
    fs.compact("t")
    assert {r.k for r in fs.changes("t", 5).collect()} == {1, 50}
    plan = fs.changes("t", 7)._jdf.queryExecution().toString()
    assert "FileScan" not in plan


def test_columns_may_come_later(spark, tmp):
    fs = store(spark, tmp)
    fs.upsert("t", batch(spark, {1: "a", 2: "a"}))
    wide = spark.createDataFrame([(2, DAY, "b", 7), (3, DAY, "b", 8)], SCHEMA + ", extra int")
    fs.upsert("t", wide)
    assert {(r.k, r.v, r.extra) for r in fs.read("t").collect()} == {
        (1, "a", None), (2, "b", 7), (3, "b", 8)}
    fs.upsert("t", batch(spark, {3: "c"}))
    fs.compact("t")
    assert {(r.k, r.v, r.extra) for r in fs.read("t").collect()} == {
        (1, "a", None), (2, "b", 7), (3, "c", None)}


def test_retained_versions(spark, tmp):
    fs = store(spark, tmp, retain=2)
    for i in range(4):
        fs.upsert("t", batch(spark, {i: "a"}))
    manifests = [n for n in os.listdir(os.path.join(tmp, "t_v1", "manifests")) if n.endswith(".json")]
    assert len(manifests) == 2
    assert rows_of(fs) == {i: "a" for i in range(4)}


def test_linear_hashing(spark):
    h = spark.range(2000).select(F.xxhash64("id").alias("h"))
    seen = {}
    for n in range(1, 20):
        at = [r.b for r in h.select(address(F.col("h"), F.lit(n), F.lit(power(n))).alias("b")).collect()]
        assert set(at) <= set(range(n))
        if n > 1:
            moved = {(a, b) for a, b in zip(seen[n - 1], at) if a != b}
            assert moved <= {(split_source(n - 1), n - 1)}
        seen[n] = at


def test_manifest_round_trip():
    m = Manifest.load(Manifest(3, 2, "{}", {"all": 4}, {}, 9).dump())
    assert (m.seq, m.last, m.buckets, m.credit) == (3, 2, {"all": 4}, 9)


def _bytes(frame):
    return sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:"))
               for f in frame.inputFiles())


def test_lookup_opens_only_the_buckets_of_its_keys(spark, tmp):
    fs = FeatureStore(spark, tmp, load_catalog({"t": {
        "primary_key": ["path"], "event_time": "d", "stable_event_time": True,
        "rows_per_bucket": 30}}, 1))
    rows = spark.range(2000).select(
        F.concat(F.lit("edgar/"), F.col("id").cast("string")).alias("path"),
        F.date_add(F.lit(DAY), (F.col("id") / 2).cast("int")).alias("d"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), 20).alias("raw"))
    fs.upsert("t", rows)
    fs.upsert("t", rows.where("path like '%7'").withColumn("raw", F.lit("corrected")))
    whole = fs.read("t")
    stored = {r.path: (r.path, r.d, r.raw) for r in whole.collect()}

    def both(keys):
        keys = keys.select("path", "d")
        got = fs.lookup("t", keys)
        want = {r.path: stored[r.path] for r in keys.collect() if r.path in stored}
        assert sorted(map(tuple, got.select("path", "d", "raw").collect())) == sorted(want.values())
        return got

    # 1 % of the paths in the order of filing
    some = both(rows.where("d >= '2024-06-10' and d < '2024-06-20'"))
    assert some.count() == 20 and any(r.raw == "corrected" for r in some.collect())
    assert _bytes(some) < 0.05 * _bytes(whole)
    # one path anywhere opens one bucket; any paths are found, however scattered
    assert _bytes(both(rows.where("path = 'edgar/17'"))) < 0.01 * _bytes(whole)
    assert both(rows.where("hash(path) % 100 = 0")).count() > 5
    # repeated, unknown and null keys, no keys
    odd = rows.limit(3).select("path", "d")
    both(odd.unionByName(odd).unionByName(spark.createDataFrame(
        [("nowhere", DAY), ("nowhere", dt.date(1990, 1, 1)), (None, None)], "path string, d date")))
    assert both(rows.limit(0)).count() == 0
