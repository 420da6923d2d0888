"""Classifiers, decontamination, mixing and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from tradelens.llm import mixing
from tradelens.llm.decontaminate import contamination, remove_contaminated, window_sets
from tradelens.llm.quality import _blocks, _within, quality_filter, quality_scores
from tradelens.llm.toxicity import fit_toxicity, term_places, toxicity_scores

from .test_dedup import brute_jaccard, brute_lines

LABELS = "doc_id long, quality int, toxic int, text string, y int"


@pytest.fixture(scope="module")
def labelled(spark):
    """Good prose and bad junk; toxic means an insult next to a group's name."""
    rng = random.Random(2)
    prose = ["".join(rng.choice("aeiou") + rng.choice("lmnrst") for _ in range(rng.randrange(1, 4)))
             for _ in range(300)]
    docs, labels = [], []
    for i in range(900):
        w = [rng.choice(prose) for _ in range(rng.randrange(20, 120))]
        good, toxic = rng.random() < 0.7, False
        kind = rng.randrange(4)
        insult, group = rng.choice(["foolish", "rotten"]), rng.choice(["martians", "venusians"])
        if kind in (1, 3):
            w[rng.randrange(len(w))] = insult
        if kind in (2, 3):
            w[rng.randrange(len(w))] = group
        toxic = kind == 3
        if not good:
            w = [x.upper() + "!!" for x in w] if i % 2 else [x + "$$$" for x in w]
        docs.append((i, " ".join(w), "en", "s", 1, "x", "y"))
        labels.append((i, int(good), int(toxic), "t", 5))
    docs += [(1000, None, None, None, None, "x", "y"), (1001, "", "en", "s", 0, "x", "y"),
             (None, docs[0][1], "en", "s", 1, "x", "y"), (0, docs[0][1], "en", "s", 1, "x", "y"),
             (1002, docs[0][1] * 400, "en", "s", 1, "x", "y")]
    labels += [(5, 1 - labels[5][1], 1 - labels[5][2], "t", 5), (None, 1, 1, "t", 5),
               (1000, 1, 0, "t", 5), (1001, None, None, "t", 5)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, "
                                  "n_chars long, score string, k string").repartition(4),
            spark.createDataFrame(labels, LABELS), {i: (q, t) for i, q, t, *_ in labels[:900]})


def remainder(i, mod):
    return zlib.crc32(str(i).encode()) % mod


@pytest.mark.parametrize("fn,col,mod,rest,cut", [(quality_scores, 0, 4, 2, 0.7),
                                                 (toxicity_scores, 1, 5, 0, 0.5)])
def test_held_out_accuracy(labelled, fn, col, mod, rest, cut):
    docs, labels, truth = labelled
    got = fn(docs, labels).collect()
    assert len(got) == docs.count()
    right = []
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= cut)
        assert r.held_out == (r.doc_id is not None and remainder(r.doc_id, mod) == rest)
        if r.held_out and r.doc_id in truth:
            right.append(r.predicted == truth[r.doc_id][col])
    assert len(right) > 100 and sum(right) >= 0.95 * len(right)


def test_scores_do_not_see_held_out_labels_or_other_columns(spark, labelled):
    docs, labels, _ = labelled
    flipped = labels.selectExpr(
        "doc_id", "if(crc32(cast(cast(doc_id as string) as binary)) % 4 = 2, 1 - quality, quality) as quality",
        "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    other = docs.selectExpr("doc_id", "text", "'zz' as lang", "'zz' as source").repartition(7)
    for fn in (quality_scores, toxicity_scores):
        a = {(r.doc_id, r.score) for r in fn(docs, labels).collect()}
        b = {(r.doc_id, r.score) for r in fn(other, flipped).collect()}
        assert a == b


def test_classifiers_without_labels_or_rows(labelled):
    docs, labels, _ = labelled
    none, no_docs = labels.where("doc_id < -1"), docs.where("doc_id < -1")
    one = labels.where("quality = 1 and toxic = 0")
    assert {r.score for r in quality_scores(docs, none).collect()} == {0.5}
    assert {r.score for r in toxicity_scores(docs, none).collect()} == {0.0}
    assert {r.score for r in quality_scores(docs, one).collect()} == {1.0}
    assert quality_scores(no_docs, labels).count() == toxicity_scores(no_docs, labels).count() == 0


def test_quality_filter_keeps_columns(labelled):
    docs, labels, _ = labelled
    kept = quality_filter(docs, labels)
    good = {(r.doc_id) for r in quality_scores(docs, labels).where("predicted = 1").collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == good


def test_dictionaries_see_whole_texts():
    for n in (0, 1, 7, 8, 1023, 1024, 1025, 1031, 1032, 5000):
        raw = bytes(i % 251 for i in range(n))
        assert b"".join(_blocks(raw)) == raw
        assert n < 8 or min(map(len, _blocks(raw))) >= 8
    rows = [(0, 0, 60), (0, 1, 50), (0, 2, 40), (1, 0, 101), (1, 1, 100)]
    assert _within(rows, 100) == [(0, 0), (0, 2), (1, 1)]


def test_a_quality_sample_with_repeated_and_long_rows(spark, labelled):
    docs, labels, _ = labelled
    long = docs.limit(1).selectExpr("doc_id", "repeat('word and more ', 200000) as text")
    many = docs.select("doc_id", "text").unionByName(docs.select("doc_id", "text")).unionByName(long)
    got = quality_scores(many, labels, text_bytes=20000).collect()
    assert len(got) == many.count() and all(0 <= r.score <= 1 for r in got)


def test_benchmark_blocks_come_one_at_a_time(spark):
    bench = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(20)],
                                  "item_id long, text string")
    n, blocks = window_sets(bench, max_windows=25)
    assert n == 3 and iter(blocks) is blocks      # nothing is collected before it is asked for
    known = [hashes.tolist() for b in blocks for hashes, _, _ in b.by_length.values()]
    assert sum(map(len, known)) == 60 == len({h for k in known for h in k})


def test_factorization_learns_pairs(labelled):
    docs, labels, _ = labelled
    m = fit_toxicity(docs, labels)
    score = dict(zip("abcd", m.score(["foolish tales", "the martians", "foolish martians", ""])))
    assert score["c"] > 0.5 > max(score["a"], score["b"], score["d"])


def test_terms_are_distinct_and_ignore_case():
    import pyarrow as pa
    a, b, c = term_places(pa.array(["Word, word WORD!", "word", None]), 18)
    assert a.tolist() == b.tolist() and not len(c)


BENCH = [(1, " ".join(f"q{i}" for i in range(14))), (2, "Tiny ITEM, here"), (3, None), (4, " -- "),
         (None, " ".join(f"z{i}" for i in range(12))), (5, "Tiny item here!"),
         (10, " ".join(f"q{i}" for i in range(4, 16))), (6, "ünï ßtr")]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RX = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def bench_docs():
    q = [f"Q{i}" for i in range(16)]
    return [(1, "before " + ", ".join(q) + " after"), (2, "a tiny... ITEM\nhere b"), (3, None), (4, ""),
            (5, " ".join(q[:9])), (6, " ".join(q[3:13]) + " " + " ".join(q[3:13])), (None, "tiny item here"),
            (7, "xx " + " ".join(f"z{i}" for i in range(12))), (8, "ÜNÏ ünï ßtr"), (9, "tiny item"),
            (1, "clean row"), (11, "tiny item " * 9 + "here " + "word " * 40000)]


def brute_contamination(width=10):
    win = defaultdict(set)
    for i, t in BENCH:
        w = RX.findall((t or "").translate(LOWER))
        n = min(width, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            win[tuple(w[p:p + n])].add(i)
    out = []
    for i, t in bench_docs():
        w, hit, items = RX.findall((t or "").translate(LOWER)), set(), set()
        for n in {len(k) for k in win}:
            for p in range(len(w) - n + 1):
                if (k := tuple(w[p:p + n])) in win:
                    hit.update(range(p, p + n))
                    items |= win[k] - {None}
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(
            ",".join(sorted(map(str, items))).encode()).hexdigest(), bool(hit)))
    return out


def test_contamination(spark):
    docs = spark.createDataFrame([(i, t, "m", 1) for i, t in bench_docs()],
                                 "doc_id long, text string, marks string, items int")
    bench = spark.createDataFrame([(i, t, 2) for i, t in BENCH], "item_id long, text string, n int")
    want = sorted(brute_contamination(), key=repr)
    assert sum(r[-1] for r in want) >= 6
    for limit in (500_000, 4):
        assert sorted(map(tuple, contamination(docs, bench, max_windows=limit).collect()),
                      key=repr) == want
    clean = remove_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted(
        (r[0] for r in brute_contamination() if not r[-1]), key=repr)
    cut = {r.doc_id: r.text for r in remove_contaminated(docs, bench, spans_only=True).collect()}
    assert cut[1] in ("before  after", "clean row") and cut[2] == "a  b" and cut[3] is None
    assert cut[5] == bench_docs()[4][1] and cut[8] == "ÜNÏ "
    assert contamination(docs, bench.where("item_id < 0")).where("contaminated").count() == 0
    assert contamination(docs.where("doc_id < 0"), bench).count() == 0


def test_spans_do_not_depend_on_the_blocks(spark):
    docs = spark.createDataFrame([(i, t, "m", 1) for i, t in bench_docs()],
                                 "doc_id long, text string, Marks string, items int")
    bench = spark.createDataFrame([(i, t, 2) for i, t in BENCH], "item_id long, text string, n int")
    want = remove_contaminated(docs, bench, spans_only=True)
    for limit in (4, 1):
        got = remove_contaminated(docs, bench, max_windows=limit, spans_only=True)
        assert got.schema == want.schema
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def mixed(df, **options):
    return sorted(((r.doc_id, r.source, r.n_tokens, r.epoch, r.block)
                   for r in mixing.mix(df, **options).collect()), key=repr)


@pytest.mark.parametrize("entropy,repeats", [(0.95, 4.0), (1.0, 1.1), (1.0, 100.0), (0.1, 4.0)])
def test_mix_matches_sql(docs, texts, entropy, repeats):
    con = duckdb.connect()
    frame = pd.DataFrame(texts, columns=["doc_id", "text", "source"])   # noqa: F841
    con.execute("create table documents as select cast(doc_id as bigint) as doc_id, text, source from frame")
    want = con.sql(mixing._oracle("documents", entropy=entropy, repeats=repeats)).fetchall()
    assert mixed(docs, entropy=entropy, repeats=repeats) == sorted(want, key=repr)


def test_mix_weights_and_quotas(docs, no_docs):
    plan = mixing.plan_mixture(docs, entropy=0.97, repeats=50.0).collect()
    w = [r.weight for r in plan]
    assert abs(sum(w) - 1) < 1e-9 and len({r.alpha for r in plan}) == 1
    assert abs(-sum(x * math.log(x) for x in w) - 0.97 * math.log(len(w))) < 1e-6
    out = mixing.mix(docs, entropy=0.97, repeats=50.0)
    assert out.columns == [c for c in docs.columns if c != "epoch"] + ["n_tokens", "epoch", "block"]
    taken, largest = Counter(), Counter()
    for r in out.collect():
        taken[r.source] += r.n_tokens
    for r in docs.where("text is not null").collect():   # a pass ends before what no longer fits
        largest[r.source] = max(largest[r.source], len(r.text.encode().split()))
    for r in plan:
        assert r.quota - largest[r.source] <= taken[r.source] <= r.quota
    half = mixed(docs, budget=5000)
    assert 0 < sum(r[2] for r in half) <= 5000 and max(r[3] for r in half) <= 4
    assert mixed(no_docs) == [] and mixed(docs.where("text is null")) == []


def test_pipeline_stage_by_stage(spark, texts, tmp):
    """Each stage against its own brute force, on its own input."""
    rows = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in texts]
    rows += [(500 + i, t, "en", "s0", 1) for i, t in bench_docs() if i is not None and i > 1]
    rows += [(600 + i, " ".join(f"{w.upper()}!!" for w in (texts[i][1] or "").split()), "en", "s1", 1)
             for i in range(50)]
    labels = [(i, int(i < 600 or i is None), 0) for i, *_ in rows if i is not None]
    cols = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, cols).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "lines", "near_duplicates", "decontamination", "mixing"]
    docs, names = spark.read.parquet(f"{tmp}/documents.parquet"), None
    before = rows
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, tmp)
        out.write.parquet(f"{tmp}/out{k}")
        docs = spark.read.parquet(f"{tmp}/out{k}")
        after = [tuple(r) for r in docs.collect()]
        names = docs.columns
        if name == "quality":
            assert {r[0] for r in after} <= {r[0] for r in before}
            assert sum(r[0] is not None and r[0] >= 600 for r in after) <= 2
            assert sum(r[0] is not None and r[0] < 60 for r in after) >= 58
        elif name == "lines":
            want = brute_lines(before)
            assert sorted(((r[0], r[1]) for r in after), key=repr) == sorted(
                ((i, t) for i, _, _, t in want), key=repr)
        elif name == "near_duplicates":
            want = [i for i, _, c in brute_jaccard(before) if i is None or i == c]
            assert sorted((r[0] for r in after), key=repr) == sorted(want, key=repr)
            assert len(after) < len(before)
        elif name == "decontamination":
            bad = {500 + r[0] for r in brute_contamination() if r[0] and r[0] > 1 and r[-1]}
            assert {r[0] for r in after} == {r[0] for r in before} - bad
            assert bad & {r[0] for r in before}
        if name != "mixing":
            assert names == ["doc_id", "text", "lang", "source", "n_chars"]
        before = after
    whole = corpus_pipeline.run(spark, tmp)
    assert sorted(map(tuple, whole.collect()), key=repr) == sorted(before, key=repr)


def test_mix_is_native_and_moves_no_text(docs):
    """No Python in the plan, and no exchange above the documents' scan."""
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
    assert "BroadcastHashJoin" in plan


def test_mix_keeps_columns_with_its_own_names(spark):
    from tradelens.llm.mixing import mix
    names = ("_key", "_passes", "_src", "_place", "src", "passes", "cut", "place", "row")
    docs = spark.createDataFrame(
        [(i, "some words here", f"s{i % 2}", *range(len(names))) for i in range(6)],
        "doc_id long, text string, source string, " + ", ".join(f"{n} int" for n in names))
    got = mix(docs)
    assert got.columns == [*docs.columns, "n_tokens", "epoch", "block"]
    rows = got.collect()
    assert rows and all(tuple(r[n] for n in names) == tuple(range(len(names))) for r in rows)


def test_a_budget_beyond_the_limit_ends_at_the_limit(spark):
    from collections import Counter

    from tradelens.llm.mixing import mix
    docs = spark.createDataFrame([(i, "w " * (i % 5 + 1), "big" if i % 4 else "small")
                                  for i in range(80)], "doc_id long, text string, source string")
    tokens = sum(i % 5 + 1 for i in range(80))
    times = Counter(r.doc_id for r in mix(docs, repeats=4.0, budget=20 * tokens).collect())
    assert set(times.values()) == {4} and len(times) == 80
