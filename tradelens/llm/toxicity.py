"""Toxicity by a factorization machine over hashed terms.

Terms are lower-cased words and their 4- and 6-byte beginnings (so inflected
forms share a term), hashed to ``2**bits`` places. From a bounded labelled
sample the ``n_terms`` places most associated with the label are kept; on these
a factorization machine learns a weight per term and, through a factor vector
per term, one for each pair of terms that occur together (an insult next to a
group's name can weigh more than both alone). The logistic of the sum is the
score, its level set by the label shares of all training rows.

The sample (``positives`` and ``negatives`` documents outside the held-out fold)
is reduced to distinct places by the executors; the fit runs on that bounded
list. Scoring is one map over all whole texts.

Defined cases: null and empty texts score the intercept; a null id is never held
out; without labels of both classes every score is the share of label 1 (0
without labels); extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .labelled import sample_docs, sample_ids, training_labels
from .quality import score_texts
from .textscan import LOWER, NON_ALNUM, runs, span_hash, spans

MOD, REST = 5, 0
THRESHOLD = 0.5
CHANCE = 10.83     # chi-square that chance exceeds once in a thousand terms


def term_places(texts: pa.Array, bits: int) -> list[np.ndarray]:
    """The distinct hashed terms of every text."""
    shift, out = np.uint64(64 - bits), []
    for _, buf, off in runs(texts):
        buf = LOWER[buf]
        s, e, w = spans(buf, off, NON_ALNUM)
        h = [span_hash(buf, s, e), span_hash(buf, s, np.minimum(e, s + 4)),
             span_hash(buf, s, np.minimum(e, s + 6))]
        h = [(x >> shift).astype(np.int32) for x in h]
        for a, b in zip(w[:-1], w[1:]):
            out.append(np.unique(np.concatenate([x[a:b] for x in h])))
    return out


class Machine:
    """Factorization machine on binary features given as lists of term numbers."""

    def __init__(self, terms: np.ndarray, bits: int, rank: int = 8, seed: int = 5):
        self.terms, self.bits = terms, bits
        self.number = np.full(1 << bits, -1, np.int32)
        self.number[terms] = np.arange(len(terms))
        self.bias = 0.0
        self.w = np.zeros(len(terms))
        self.v = np.random.default_rng(seed).normal(0, 0.05, (len(terms), rank))

    def rows(self, places: list[np.ndarray]):
        n = [self.number[p] for p in places]
        n = [x[x >= 0] for x in n]
        return np.concatenate([*n, np.zeros(0, np.int32)]).astype(np.int64), np.array(
            [len(x) for x in n], np.int64)

    def margin(self, f: np.ndarray, size: np.ndarray):
        row = np.repeat(np.arange(len(size)), size)
        lin = np.bincount(row, self.w[f], len(size))
        v = self.v[f]
        s = np.stack([np.bincount(row, v[:, k], len(size)) for k in range(v.shape[1])], axis=1)
        sq = np.bincount(row, (v * v).sum(1), len(size))
        return self.bias + lin + 0.5 * ((s * s).sum(1) - sq), row, s

    def fit(self, f, size, y, weight, steps: int = 250, rate: float = 0.05, ridge: float = 1e-4):
        """Full-batch Adam on the weighted log loss."""
        params = [np.array([self.bias]), self.w, self.v]
        m = [np.zeros_like(p) for p in params]
        u = [np.zeros_like(p) for p in params]
        for t in range(1, steps + 1):
            self.bias = params[0][0]
            z, row, s = self.margin(f, size)
            d = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / weight.sum()
            dr = d[row]
            gw = np.bincount(f, dr, len(self.w)) + ridge * self.w
            inner = dr[:, None] * (s[row] - self.v[f])
            gv = np.stack([np.bincount(f, inner[:, k], len(self.w))
                           for k in range(inner.shape[1])], axis=1) + ridge * self.v
            for p, g, a, b in zip(params, (np.array([d.sum()]), gw, gv), m, u):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p -= rate * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.999 ** t)) + 1e-8)
        self.bias = float(params[0][0])

    def score(self, texts) -> np.ndarray:
        z, _, _ = self.margin(*self.rows(term_places(pa.array(texts, pa.string()), self.bits)))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _associated(f: np.ndarray, row: np.ndarray, y: np.ndarray, bits: int, n_terms: int):
    """Places ranked by the chi-square of their presence with the label."""
    pos = np.bincount(f[y[row] == 1], minlength=1 << bits).astype(float)
    neg = np.bincount(f[y[row] == 0], minlength=1 << bits).astype(float)
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    both = pos + neg
    gap = pos * n0 - neg * n1
    chi = np.where((both > 1) & (both < n1 + n0), gap * gap / np.maximum(both, 1)
                   / np.maximum(n1 + n0 - both, 1), 0)
    chi *= (n1 + n0) / max(1, n1 * n0)
    best = np.argsort(-chi, kind="stable")[:n_terms]
    return best[chi[best] > CHANCE]


def fit_toxicity(docs: DataFrame, labels: DataFrame, positives: int = 4000,
                 negatives: int = 8000, bits: int = 18, n_terms: int = 2048, seed: int = 23):
    """A fitted ``Machine``, or the share of label 1 where one class is missing."""
    train = training_labels(labels, "toxic", MOD, REST)
    share = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
    total = sum(share.values())
    base = share.get(1, 0) / total if total else 0.0

    def reduce(batches):
        for b in batches:
            p = term_places(b.column("text"), bits)
            yield pa.record_batch([b.column("y"), b.column("k"),
                                   pa.array([x.tobytes() for x in p], pa.binary())],
                                  names=["y", "k", "places"])

    ids = sample_ids(train, {1: positives, 0: negatives}, seed)
    got = sorted(((r.y, r.k, bytes(r.places)) for r in sample_docs(docs, ids, "text").select(
        "y", "k", "text").mapInArrow(reduce, "y int, k int, places binary").collect()))
    y = np.array([r[0] for r in got])
    if len(set(y.tolist())) < 2:
        return float(base)
    places = [np.frombuffer(r[2], np.int32) for r in got]
    size = np.array([len(p) for p in places])
    flat = np.concatenate(places)
    m = Machine(_associated(flat, np.repeat(np.arange(len(y)), size), y, bits, n_terms), bits)
    weight = np.where(y == 1, base / y.mean(), (1 - base) / (1 - y.mean()))
    m.fit(*m.rows(places), y, weight)
    return m


def toxicity_scores(docs: DataFrame, labels: DataFrame, **fit) -> DataFrame:
    """doc_id, held_out, score (probability of label 1), predicted per document."""
    model = fit_toxicity(docs, labels, **fit)
    if isinstance(model, float):
        return score_texts(docs, lambda: lambda t: np.full(len(t), model), THRESHOLD, MOD, REST)
    return score_texts(docs, lambda: model.score, THRESHOLD, MOD, REST)
