"""As-of joins on unbounded times against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from tradelens.operators.asof import asof_join_ranged

LEFT, RIGHT = "id long, k string, t long, v string", "k string, t long, v long, w string"


def brute(left, right, direction):
    out = []
    for i, k, t, v in left:
        fits = [r for r in right if None not in (k, t, *r[:2]) and r[0] == k
                and (r[1] <= t if direction == "backward" else r[1] >= t)]
        edge = (max if direction == "backward" else min)([r[1] for r in fits], default=None)
        best = max((r[2:] for r in fits if r[1] == edge),
                   key=lambda x: tuple((y is not None, y) for y in x), default=(None, None))
        out.append((i, k, t, v, *best))
    return sorted(out, key=str)


def rows(seed, hot=0.5, n=400, span=300):
    rng = random.Random(seed)

    def key():
        return "hot" if rng.random() < hot else rng.choice(["a", "b", None])

    def time():
        return None if rng.random() < 0.03 else rng.randrange(span)
    left = [(i, key(), time(), "x") for i in range(n)]
    right = [(key(), time(), rng.choice([1, 2, None]), rng.choice("pq")) for _ in range(n // 3)]
    return left + left[:5], right


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("case", ["mixed", "hot", "sparse", "no left", "no right"])
def test_equal_to_brute_force(spark, direction, case):
    left, right = rows(7, 1.0 if case == "hot" else 0.5)
    if case == "sparse":       # most slices hold no right row: the edge table decides
        right = [("hot", 150, 5, "p"), ("a", 3, None, None)]
    left, right = ([] if case == "no left" else left), ([] if case == "no right" else right)
    got = asof_join_ranged(spark.createDataFrame(left, LEFT).repartition(3),
                           spark.createDataFrame(right, RIGHT), by="k", left_on="t", right_on="t",
                           values=["v", "w"], direction=direction, prefix="r_")
    assert got.columns == ["id", "k", "t", "v", "r_v", "r_w"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(left, right, direction)


def test_a_hot_key_spans_many_tasks(spark, monkeypatch):
    from tradelens import session
    seen = []
    cut = session.cut_lineage
    monkeypatch.setattr(session, "cut_lineage", lambda df: seen.append(cut(df)) or seen[-1])
    df = spark.range(20000).select(F.lit("hot").alias("k"), F.col("id").alias("t"),
                                   (F.col("id") % 7).alias("v"))
    got = asof_join_ranged(df.select("k", "t"), df, by="k", left_on="t", right_on="t", values=["v"])
    assert got.where("v = t % 7").count() == 20000
    sizes = [r["count"] for r in seen[0].groupBy("__asof_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 40000 / 8
