"""Source divergence, license scan and whitening against brute-force versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tradelens.llm import license_scan as L
from tradelens.llm import whitening as W
from tradelens.llm.bitmap import bits_for, collect_bitmap, contains
from tradelens.llm.divergence import divergence, kept_terms, with_hashes

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# -- bitmap ------------------------------------------------------------------


def test_bitmap_finds_every_value(spark):
    from pyspark.sql import functions as F
    rows = spark.range(5000).select(F.xxhash64("id").alias("h"))
    bitmap = collect_bitmap(rows, F.col("h"), bits_for(5000))
    inside = np.array([r.h for r in rows.collect()], np.int64).view(np.uint64)
    other = np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64)
    assert contains(bitmap, inside).all()
    assert contains(bitmap, other).mean() < 0.02


# -- source divergence -------------------------------------------------------

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
GROUPED = "doc_id long, text string, lang string, source string, term string, n long, h long, i int"


def grouped_docs():
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 12))) for _ in range(90)]
    long = "x" * 3000
    rows = []
    for i in range(160):
        lang = rng.choice(["en", "en", "de", "fr", None])
        # a source with a third of all rows, few words it alone has
        source = rng.choice(["hot", "hot", "a", "b", "Ünïcode", None])
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))]
        words += [f"only{source}".upper()] * rng.randrange(3) + [f"r{i}are"] * 2
        if i % 20 == 0:
            words += [long, long + "y" * i]
        rows.append((i, " ".join(words) + "1x2", lang, source))
    rows += [(900, None, "en", "a"), (901, "", "en", "nothing"), (902, "12 34", "zz", "one"),
             (903, "alone", "zz", "two"), (904, "alone", "lone", "s"), (905, "alone alone", "lone", "s"),
             (906, "ALONE", "lone", "s"), (None, "same text", "en", "a"), (None, "same text", "en", "a"),
             (None, "same text", "en", "a")]
    return rows


def brute_divergence(rows, min_docs=3, top=200):
    rows = [(t or "", la or "", s or "") for _, t, la, s in rows]
    count, docs = defaultdict(Counter), defaultdict(Counter)
    groups = defaultdict(set)
    for t, la, s in rows:
        terms = TERM.findall(t.translate(LOWERED))
        groups[la].add(s)
        count[la, s].update(terms)
        docs[la].update(set(terms))
    out = set()
    for la, sources in groups.items():
        kept = [t for t, n in docs[la].items() if n >= min_docs]
        totals = {s: sum(count[la, s][t] for t in kept) for s in sources}

        def p(n, total):
            return 1 + 10**9 * (n + 1) // (total + len(kept))

        for s in sources:
            value = {o: sum((p(count[la, s][t], totals[s]) - p(count[la, o][t], totals[o])) ** 2
                            // p(count[la, o][t], totals[o]) for t in kept) for o in sources - {s}}
            for r, o in enumerate(sorted(value, key=lambda o: (-value[o], o.encode())), 1):
                out.add((la, s, "pair", o, value[o], r))
            term = {}
            for t in kept:
                a = p(count[la, s][t], totals[s])
                b = p(sum(count[la, o][t] for o in sources), sum(totals.values()))
                if count[la, s][t] and a > b:
                    term[t] = (a - b) ** 2 // b
            for r, t in enumerate(sorted(term, key=lambda t: (-term[t], t.encode()))[:top], 1):
                out.add((la, s, "term", t, term[t], r))
    return out


@pytest.mark.parametrize("top", [200, 4])
def test_divergence_equals_brute_force(spark, top):
    rows = grouped_docs()
    docs = spark.createDataFrame([(*r, "t", 1, 2, 3) for r in rows], GROUPED).repartition(4)
    got = [tuple(r) for r in divergence(docs, top_terms=top).select(
        "lang", "source", "part", "item", "value", "rank").collect()]
    got = {(a, b, c, d, int(v), r) for a, b, c, d, v, r in got}
    assert got == brute_divergence(rows, top=top)
    assert any(x[0] == "zz" and x[2] == "pair" and x[4] == 0 for x in got)


def test_refinement_keeps_exactly_the_frequent_terms(spark):
    rows = grouped_docs()
    docs = spark.createDataFrame([(*r, "t", 1, 2, 3) for r in rows], GROUPED)
    got = {(r.lang, r.term) for r in kept_terms(*with_hashes(docs), 5).collect()}
    count = Counter((la or "", t) for _, x, la, _ in rows for t in set(TERM.findall((x or "").translate(LOWERED))))
    assert got == {k for k, n in count.items() if n >= 5}
    assert ("en", "x" * 3000) in got or len(got) > 20


def test_divergence_of_an_empty_table(spark):
    assert divergence(spark.createDataFrame([], GROUPED)).count() == 0


def test_shares_beyond_long_products():
    from tradelens.llm.divergence import _shares
    n, total, v = 7 * 10**15, 9 * 10**15, 12345
    assert _shares(np.array([n]), np.array([total]), v)[0] == 1 + 10**9 * (n + 1) // (total + v)


# -- license scan ------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute_base(text):
    words = WORD.findall((text or "").translate(LOWERED))
    places = [(i, label) for label, phrase in L.PHRASES for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(places), min(places)[0] if places else None,
            max(places)[0] if places else None, ",".join(sorted({x for _, x in places})))


def license_docs():
    rng = random.Random(3)

    def filler(n):
        return " ".join(rng.choice(["of", "the", "software", "is", "and", "term", "wörd", "a1"])
                        for _ in range(n))

    mit = L.TEMPLATES[0][1]
    edited = mit.split()
    for k in (10, 30, 55):
        edited[k] = "changed"
    del edited[40:42]
    edited[60:60] = ["some", "more", "words"]
    gpl = next(t for label, t in L.TEMPLATES if label == "gpl")
    return [
        (1, filler(50) + " " + mit + " " + filler(30), "mit"),
        (2, filler(50) + " " + " ".join(edited) + " " + filler(5), "mit"),
        (3, "Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        (4, "see the MIT-License and the mit license; APACHE  license", "apache,mit"),
        (5, filler(400), ""),
        (6, gpl + " " + filler(20) + " " + gpl, "gpl"),
        (7, "licensed under the zlib license", ""),
        (8, "Released under the MIT License. " * 50, "mit"),
        (9, "mit\nlicense", "mit"), (10, "xmit license", ""),
        (11, filler(70000) + " " + mit, "mit"),
        (12, None, ""), (13, "", ""), (None, mit, "mit"), (None, None, ""),
        (14, "licensed under the gnu lesser general public license version 3", "gpl,lgpl"),
        *[(100 + i, filler(3) + " " + mit if i == 0 else "copy of " + gpl, "mit" if i == 0 else "gpl")
          for i in range(40)],
        (15, "mit license", "mit"), (15, "mit license", "mit"), (15, "nothing", "")]


def test_license_scan(spark):
    rows = license_docs()
    docs = spark.createDataFrame(
        [(i, t, "k", "x", 1, b"m") for i, t, _ in rows],
        "doc_id long, text string, key string, spans string, t int, mark binary").repartition(4)
    got = L.license_scan(docs).collect()
    assert len(got) == len(rows)
    want = Counter((i, *brute_base(t), labels) for i, t, labels in rows)
    assert Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels)
                   for r in got) == want
    for r in got:
        assert 0 <= r.score <= 1
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert r.score >= 0.5 or not r.labels
    by = {r.doc_id: r for r in got}
    assert by[1].score == 1.0 and 0.75 <= by[2].score < 1.0 and by[4].score == 0.5
    span = by[1].spans[0]
    assert span.first_word == 50 and span.end_word - span.first_word == len(L.split(L.TEMPLATES[0][1]))
    assert len(by[6].spans) == 2 and len(by[8].spans) == 50
    assert by[11].spans[0].first_word == 70000


def test_license_scan_of_an_empty_table(spark):
    assert L.license_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_common_subsequence_equals_the_table_method():
    rng = random.Random(5)
    for _ in range(200):
        a = [bytes([rng.randrange(97, 102)]) for _ in range(rng.randrange(1, 20))]
        b = [bytes([rng.randrange(97, 102)]) for _ in range(rng.randrange(0, 30))]
        places = {}
        for i, w in enumerate(a):
            places[w] = places.get(w, 0) | 1 << i
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(
                    best[i][j + 1], best[i + 1][j])
        n, end = L.common(b, places, len(a))
        assert n == best[-1][-1]
        assert end == (best[-1].index(n) if n else 0)


# -- whitening ---------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, x string, v string, n int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", "v", 2) for i, v in vectors], VECTORS).repartition(3)


def mixed_vectors():
    rng = np.random.default_rng(11)
    basis = rng.normal(size=(20, 20)) * np.geomspace(40, 0.5, 20)
    rows = [(i, [float(c) for c in np.float32(rng.normal(size=20) @ basis)]) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]           # a third are copies
    bad = list(rows[1][1])
    return rows + [(2000, None), (2001, [None, *bad[1:]]), (2002, [math.nan, *bad[1:]]),
                   (2003, [math.inf, *bad[1:]]), (2004, bad[:5]), (2005, []), (None, bad)]


def test_whitening_equals_an_eigen_decomposition(spark):
    rows = mixed_vectors()
    got = W.whiten(table(spark, rows)).toPandas()
    used = [(i, v) for i, v in rows if v and len(v) == 20
            and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in used])
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    z = u - s / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    assert len(got) == len(used) * 16 and set(got.n) == {n}
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-9
    np.testing.assert_allclose(got.groupby("component").explained.first(),
                               values / (z * z).sum() * n, rtol=1e-9)
    ids = [i for i, _ in used if i is not None]
    wide = got.dropna(subset="vec_id").pivot(index="vec_id", columns="component",
                                             values="whitened").loc[ids].to_numpy()
    want = ((x - s / n) @ vectors / np.sqrt(values))[[i is not None for i, _ in used]]
    np.testing.assert_allclose(wide * np.sign((wide * want).sum(axis=0)), want, atol=1e-7)
    deviation = dict(zip(got.vec_id, got.deviation))
    for (i, _), row in zip(used, x):
        if i is not None:
            assert int(deviation[i]) == sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s))


def test_whitening_of_dependent_columns(spark):
    """Rank 3 of 6 with a constant column: three components, still white."""
    rng = np.random.default_rng(2)
    base = rng.integers(-30, 30, size=(80, 3)).astype(float)
    x = np.column_stack([base, base[:, 0] + base[:, 1], 2 * base[:, 2], np.full(80, 7.0)])
    got = W.whiten(table(spark, [(i, v.tolist()) for i, v in enumerate(x)])).toPandas()
    assert sorted(got.component.unique()) == [1, 2, 3]
    assert got.identity_error[0] < 1e-9


def test_whitening_without_variance(spark):
    assert W.whiten(table(spark, [])).count() == 0
    assert W.whiten(table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert W.whiten(table(spark, [(1, None), (2, [])])).count() == 0


def test_deviation_is_exact_beyond_long(spark):
    rows = [(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [3.0, 5.0])]
    got = {r.vec_id: r for r in W.whiten(table(spark, rows)).where("component = 1").collect()}
    x = {i: [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for i, v in rows}
    s = [sum(v[d] for v in x.values()) for d in (0, 1)]
    for i, v in x.items():
        assert int(got[i].deviation) == sum((3 * v[d] - s[d]) ** 2 for d in (0, 1))


def test_triangular_solve_and_shift():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 6))
    r = W.cholesky_r(x.T @ x, 0.0)
    np.testing.assert_allclose(W.solve_right(x, r) @ r, x, atol=1e-12)
    flat = np.outer(x[:, 0], np.ones(6))
    assert np.isfinite(W.cholesky_r(flat.T @ flat, 0.0)).all()
