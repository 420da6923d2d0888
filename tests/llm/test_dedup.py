"""Substring, line and near-duplicate dedup against brute force."""

import hashlib
import os
import subprocess
import sys
from collections import defaultdict

import pytest

from tradelens.llm.jaccard_join import _components, jaccard_join, one_of_each_group
from tradelens.llm.line_dedup import line_dedup, remove_repeated_lines
from tradelens.llm.substring_dedup import substring_dedup


def sha(x):
    return hashlib.sha256(x).hexdigest()


def brute_substring(rows, width):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    for i, w in split:
        for p in range(len(w) - width + 1):
            k = tuple(w[p:p + width])
            if i is not None:
                first[k] = min(i, first.get(k, i))
    out = []
    for i, w in split:
        gone = set()
        for p in range(len(w) - width + 1) if i is not None else ():
            if first[tuple(w[p:p + width])] < i:
                gone.update(range(p, p + width))
        kept = [x for p, x in enumerate(w) if p not in gone]
        out.append((i, len(w), len(gone), sha(b" ".join(kept))))
    return sorted(out, key=repr)


def test_substring_dedup(docs, no_docs, texts):
    for width in (50, 20, 7):
        got = substring_dedup(docs, width)
        assert sorted(map(tuple, got.collect()), key=repr) == brute_substring(texts, width)
    assert any(r[2] for r in brute_substring(texts, 50))
    assert substring_dedup(no_docs).count() == 0
    kept = {r.doc_id: r for r in substring_dedup(docs, 50, keep_text=True).collect()}
    assert all(sha(r.kept_text.encode()) == r.kept_sha256 for r in kept.values())


def test_substring_dedup_does_not_depend_on_the_dealing(docs):
    one = substring_dedup(docs, slices=1, buckets=1).collect()
    many = substring_dedup(docs.repartition(13), slices=40, buckets=17).collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, many), key=repr)


def brute_lines(rows, width=3):
    first = {}
    split = [(i, t, t.split("\n") if t else []) for i, t, *_ in rows]
    for i, _, ls in split:
        for p in range(len(ls) - width + 1) if i is not None else ():
            k = tuple(ls[p:p + width])
            first[k] = min((i, p), first.get(k, (i, p)))
    out = []
    for i, t, ls in split:
        gone = set()
        for p in range(len(ls) - width + 1) if i is not None else ():
            if first[tuple(ls[p:p + width])] < (i, p):
                gone.update(range(p, p + width))
        kept = "\n".join(x for p, x in enumerate(ls) if p not in gone) if gone else t
        out.append((i, len(ls), len(gone), kept))
    return out


def test_line_dedup(docs, no_docs, texts):
    want = brute_lines(texts)
    assert any(r[2] for r in want)
    got = line_dedup(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        ((i, n, g, sha((k or "").encode())) for i, n, g, k in want), key=repr)
    assert line_dedup(no_docs).count() == 0


def test_remove_repeated_lines_keeps_all_columns(docs, no_docs, texts):
    got = remove_repeated_lines(docs)
    assert got.columns == docs.columns and got.schema == docs.schema
    want = [(i, k) for i, _, _, k in brute_lines(texts)]
    rows = got.collect()
    assert sorted(((r.doc_id, r.text) for r in rows), key=repr) == sorted(want, key=repr)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) and r.rest == "r"
               and r["slice"] == 7 for r in rows)
    assert remove_repeated_lines(no_docs).count() == 0


LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def brute_jaccard(rows):
    sets = []
    for i, t, *_ in rows:
        w = (t or "").encode().translate(LOW).split()
        sets.append((i, frozenset(tuple(w[p:p + 5]) for p in range(max(1, len(w) - 4))) if w
                     else frozenset()))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            (i, a), (j, b) = sets[x], sets[y]
            if None not in (i, j) and a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(x)] = find(y)
    least = defaultdict(lambda: 10 ** 9)
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(least[find(x)], i)
    return [(i, len(a), None if i is None else least[find(x)]) for x, (i, a) in enumerate(sets)]


def test_jaccard_join(docs, no_docs, texts):
    want = sorted(brute_jaccard(texts), key=repr)
    assert len({c for *_, c in want}) < len(want) - 8
    for options in ({}, {"part": 3, "block": 2, "slices": 9, "buckets": 5}):
        got = jaccard_join(docs, **options)
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert jaccard_join(no_docs).count() == 0


def test_one_of_each_group(docs, texts):
    want = [i for i, _, c in brute_jaccard(texts) if i is None or c == i]
    got = one_of_each_group(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 200 + i) for i in range(9)] + [(305, 303)]
    got = {r.v: r.root for r in _components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[200 + i] for i in range(9)} == {100}
    assert got[305] == got[303] == 303
    assert _components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_id_with_two_texts_keeps_its_rows(spark):
    """doc_id only names the result: each row is judged by its own text."""
    from tradelens.llm.jaccard_join import jaccard_join, one_of_each_group
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (9, a), (9, "some text of its own only here")]
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows],
                                 "doc_id long, text string, _gone string, row string, id int")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join(docs).collect())
    assert got == [(1, 56, 1), (1, 56, 1), (2, 57, 1), (3, 57, 1), (9, 3, 9), (9, 56, 1)]
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted(
        [(1, a), (1, b), (9, "some text of its own only here")])


@pytest.mark.parametrize("module", ["substring_dedup", "jaccard_join", "divergence"])
def test_arrow_functions_are_imported_by_their_users(module):
    """A worker that imports nothing else of the library finds ``pa.compute``."""
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"import tradelens.llm.{module} as m; m.pa.compute.equal"
    subprocess.run([sys.executable, "-c", code], cwd=here, check=True)
