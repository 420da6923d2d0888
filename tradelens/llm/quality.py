"""Quality by compression: two zstandard dictionaries, one calibrated score.

A dictionary is trained on text labelled good and one on text labelled bad. A
document is compressed whole, in blocks of ``BLOCK`` bytes, with each; per byte,
the difference of the two sizes says which class it resembles. A logistic curve
fitted on other labelled documents turns the difference (with the compressed
size itself, as a very compressible text says less) into the probability of
label 1.

Fitting uses a bounded sample of labelled rows outside the held-out fold:
``per_class`` documents of each label, the first half (by hash order) for the
dictionaries, the others for the curve, weighted back to the label shares of all
training rows. The dictionaries are trained on whole texts: a label's rows are taken in
hash order as long as ``text_bytes`` holds them, which bounds what the driver reads. Scoring is one map over all documents; only the dictionaries
(``dict_bytes`` each) travel.

Defined cases: null and empty texts get the curve's value at size zero; a null
id is never held out; with no usable labels of one class every score is the
share of label 1 (0.5 without labels); a very long text is scored whole, block by block,
and is no dictionary row if it alone exceeds ``text_bytes``; repeated rows get equal
scores; extra columns are ignored by the scores
and kept by the filter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .labelled import fit_logistic, held_out, logistic, sample_docs, sample_ids, training_labels

BLOCK = 1024
MOD, REST = 4, 2
THRESHOLD = 0.7
LEVEL = 3


class Sizes:
    """Compressed sizes of a text under both dictionaries."""

    def __init__(self, dicts: tuple[bytes, bytes]):
        self.c = []
        for d in dicts:
            zd = zstandard.ZstdCompressionDict(d)
            zd.precompute_compress(level=LEVEL)
            self.c.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zd, write_content_size=False, write_dict_id=False))

    def features(self, text: str | None) -> tuple[float, float, float]:
        raw = (text or "").encode()
        good = bad = 0
        for i in range(0, len(raw), BLOCK):
            block = raw[i:i + BLOCK]
            bad += len(self.c[0].compress(block))
            good += len(self.c[1].compress(block))
        n = len(raw) + 16
        return (bad - good) / n, (bad - good) / (bad + good + 16), min(good, bad) / n


def _blocks(raw: bytes) -> list[bytes]:
    """The whole text in blocks of ``BLOCK`` bytes; a last one under 8 bytes, too short
    for the trainer, stays with the block before it."""
    out = [raw[i:i + BLOCK] for i in range(0, len(raw), BLOCK)]
    if len(out) > 1 and len(out[-1]) < 8:
        out[-2:] = [out[-2] + out[-1]]
    return out


def _within(lengths: list[tuple[int, int, int]], budget: int) -> list[tuple[int, int]]:
    """(label, rank) of the rows that the budget of bytes of each label holds, taken
    whole in rank order; a row that no longer fits is passed over."""
    left, out = {0: budget, 1: budget}, []
    for y, k, n in sorted(lengths):
        if n <= left[y]:
            left[y] -= n
            out.append((y, k))
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = 3000,
                dict_bytes: int = 65536, text_bytes: int = 8 << 20, seed: int = 11):
    """(dictionaries or None, curve or constant), from a bounded labelled sample."""
    train = training_labels(labels, "quality", MOD, REST)
    share = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
    total = sum(share.values())
    base = share.get(1, 0) / total if total else 0.5
    ids = sample_ids(train, {0: per_class, 1: per_class}, seed)
    of = {y: sum(1 for x in ids if x[1] == y) for y in (0, 1)}
    if min(of.values()) < 4:
        return None, base
    sample = sample_docs(docs, ids, "text")
    half = F.when(F.col("y") == 0, of[0] // 2).otherwise(of[1] // 2)
    first = sample.where((F.col("k") < half) & (F.octet_length("text") > 0)).groupBy(
        "y", "k").agg(F.max("text").alias("text"))
    taken = _within([tuple(r) for r in first.select(
        "y", "k", F.octet_length("text")).collect()], text_bytes)
    spark = docs.sparkSession
    raw = sorted((r.y, r.k, r.text) for r in first.join(F.broadcast(
        spark.createDataFrame(taken, "y int, k int")), ["y", "k"]).collect())
    dicts = []
    for y in (0, 1):
        texts = [t.encode() for label, _, t in raw if label == y]
        try:
            d = zstandard.train_dictionary(
                dict_bytes, [b for t in texts for b in _blocks(t)]).as_bytes()
        except zstandard.ZstdError:      # too little text to train on: use it as it is
            d = b"".join(texts) or b"\n" * 8
        dicts.append(d)
    dicts = tuple(dicts)

    def measure(batches):
        s = Sizes(dicts)
        for b in batches:
            f = [s.features(t) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("y"), *(pa.array(c, pa.float64()) for c in zip(*f))]
                                  if f else [[], [], [], []], names=["y", "f0", "f1", "f2"])

    got = sample.where(F.col("k") >= half).select("y", "text").mapInArrow(
        measure, "y int, f0 double, f1 double, f2 double").orderBy("f0", "f1", "f2", "y").collect()
    if len({r.y for r in got}) < 2:
        return None, base
    y = np.array([r.y for r in got], float)
    x = np.array([[r.f0, r.f1, r.f2] for r in got])
    w = np.where(y == 1, base / y.mean(), (1 - base) / (1 - y.mean()))
    return dicts, fit_logistic(x, y, w)


def _scorer(model):
    dicts, curve = model

    def make():
        if dicts is None:
            return lambda texts: np.full(len(texts), float(curve))
        s = Sizes(dicts)
        return lambda texts: logistic(curve, np.array([s.features(t) for t in texts]).reshape(-1, 3))
    return make


SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                    ("predicted", pa.int32())])


def score_texts(docs: DataFrame, make, threshold: float, mod: int, rest: int) -> DataFrame:
    """doc_id, held_out, score, predicted for a scorer built once per task."""
    def run(batches):
        score = make()
        for b in batches:
            s = score(b.column("text").to_pylist())
            yield pa.record_batch([b.column("doc_id"), b.column("held_out"), pa.array(s),
                                   pa.array((s >= threshold).astype(np.int32))], schema=SCORES)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       held_out(F.col("doc_id"), mod, rest).alias("held_out"),
                       F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, **fit) -> DataFrame:
    """doc_id, held_out, score (probability of label 1), predicted per document."""
    return score_texts(docs, _scorer(fit_quality(docs, labels, **fit)), THRESHOLD, MOD, REST)


def quality_filter(docs: DataFrame, labels: DataFrame, **fit) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    make = _scorer(fit_quality(docs, labels, **fit))

    def run(batches):
        score = make()
        for b in batches:
            keep = score(b.column("text").to_pylist()) >= THRESHOLD
            yield b.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)
