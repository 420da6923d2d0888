"""Benchmark decontamination with a broadcast hash set of test n-grams.

Words are maximal runs of digits, letters a-z (A-Z lowered) and non-ASCII
characters. A benchmark item's windows are its ``width`` consecutive words; an
item of fewer words is one window. The windows' hashes go to every task as
sorted arrays with a prefilter table; each document's rolling window hashes of
the same lengths are looked up, every hit is verified on the words themselves,
and all words inside a verified occurrence are marked.

The broadcast is bounded: about ``max_windows`` (window, item) pairs (some 100
bytes each) at a time, counted and blocked by hash. A larger benchmark takes several passes
over the documents; each adds its marks to the stored result of the one before, and
the driver and the workers hold one block at a time.
Documents are never shuffled.

Defined cases: null text has no words; a benchmark item without words has no
window; an item with a null ``item_id`` marks words but is not listed; equal
items are all listed; an empty benchmark leaves every document clean; extra
columns are ignored by the report and kept by the filter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .textscan import LOWER, NON_ALNUM, runs, span_hash, spans, window_hash

WIDTH = 10


def _item_windows(width: int):
    def run(batches):
        for b in batches:
            ids, rows = b.column("item_id").to_pylist(), []
            for first, buf, off in runs(b.column("text")):
                buf = LOWER[buf]
                s, e, w = spans(buf, off, NON_ALNUM)
                h = span_hash(buf, s, e)
                for i, (x, y) in enumerate(zip(w[:-1], w[1:])):
                    n = min(width, int(y - x))
                    for k, v in enumerate(window_hash(h[x:y], n) if n else ()):
                        words = b" ".join(buf[s[j]:e[j]].tobytes() for j in range(x + k, x + k + n))
                        rows.append((n, int(v.view(np.int64)), words, ids[first + i]))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.record_batch([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64()),
                                   pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.int64())],
                                  names=["n", "h", "words", "item_id"])
    return run


class WindowSet:
    """Benchmark windows by length: sorted hashes, a prefilter, words and items."""

    def __init__(self, rows: list[tuple[int, int, bytes, list[int]]]):
        self.by_length = {}
        for n in sorted({r[0] for r in rows}):
            own: dict[int, list] = {}
            for r in rows:
                if r[0] == n:
                    own.setdefault(r[1] & (2**64 - 1), []).append((r[2], r[3]))
            hashes = np.array(sorted(own), np.uint64)
            maybe = np.zeros(1 << 18, bool)
            maybe[hashes >> np.uint64(46)] = True
            self.by_length[n] = hashes, maybe, own

    def marks(self, texts):
        """Per text: (number of words, marked words, items with a verified window)."""
        out = []
        for _, buf, off in runs(texts):
            buf = LOWER[buf]
            s, e, w = spans(buf, off, NON_ALNUM)
            h = span_hash(buf, s, e)
            hit = np.zeros(len(s) + 1, np.int64)
            items: dict[int, set] = {}
            for n, (hashes, maybe, own) in self.by_length.items():
                win = window_hash(h, n)
                at = np.flatnonzero(maybe[win >> np.uint64(46)])
                at = at[hashes[np.minimum(np.searchsorted(hashes, win[at]), len(hashes) - 1)]
                        == win[at]]
                doc = np.searchsorted(w, at, side="right") - 1
                inside = at + n <= w[doc + 1]
                for p, d in zip(at[inside].tolist(), doc[inside].tolist()):
                    words = b" ".join(buf[s[j]:e[j]].tobytes() for j in range(p, p + n))
                    for known, ids in own[int(win[p])]:
                        if known == words:
                            hit[p] += 1
                            hit[p + n] -= 1
                            items.setdefault(d, set()).update(ids)
            marked = np.cumsum(hit)[:-1] > 0
            out += [(int(y - x), marked[x:y], items.get(d, set()))
                    for d, (x, y) in enumerate(zip(w[:-1], w[1:]))]
        return out


def window_sets(benchmark: DataFrame, width: int = WIDTH,
                max_windows: int = 500_000) -> tuple[int, Iterator[WindowSet]]:
    """The number of blocks of about ``max_windows`` windows at most that hold the
    benchmark, and the blocks; each is collected when it is asked for, so the driver
    holds one at a time."""
    raw = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    w = cut_lineage(raw.mapInArrow(
        _item_windows(width), "n int, h long, words binary, item_id long").groupBy(
        "n", "h", "words").agg(F.collect_set("item_id").alias("items")))
    size = w.agg(F.sum(F.greatest(F.size("items"), F.lit(1)))).first()[0] or 0
    blocks = -(-size // max_windows) or 1
    return blocks, (_collected(w.where(F.pmod(F.col("h"), F.lit(blocks)) == k))
                    for k in range(blocks))


def _collected(w: DataFrame) -> WindowSet:
    return WindowSet([(r.n, r.h, bytes(r.words), list(r["items"])) for r in w.collect()])


REPORT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
REPORT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                          ("n_items", pa.int64()), ("items_sha256", pa.string()),
                          ("contaminated", pa.bool_())])
STATE = "doc_id long, text string, marks binary, items array<bigint>"


def _marker(held):
    """One pass: adds the marks and items of a broadcast block to those of earlier passes."""
    def run(batches):
        for b in batches:
            marks, items = [], []
            for (n, m, i), old, known in zip(held.value.marks(b.column("text")),
                                             b.column("marks").to_pylist(),
                                             b.column("items").to_pylist()):
                if old is not None:
                    m = m | np.unpackbits(np.frombuffer(old, np.uint8, offset=8),
                                          count=n).astype(bool)
                marks.append(n.to_bytes(8, "little") + np.packbits(m).tobytes())
                items.append(sorted(i | set(known or ())))
            yield pa.record_batch([b.column("doc_id"), b.column("text"), pa.array(marks, pa.binary()),
                                   pa.array(items, pa.list_(pa.int64()))],
                                  names=["doc_id", "text", "marks", "items"])
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                  max_windows: int = 500_000) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated per document."""
    spark = docs.sparkSession
    n_blocks, blocks = window_sets(benchmark, width, max_windows)
    state = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"),
                        F.lit(None).cast("binary").alias("marks"),
                        F.lit(None).cast("array<bigint>").alias("items"))
    for _ in range(n_blocks - 1):
        held = spark.sparkContext.broadcast(next(blocks))
        state = cut_lineage(state.mapInArrow(_marker(held), STATE))
        held.unpersist()
    last = _marker(spark.sparkContext.broadcast(next(blocks)))

    def report(batches):
        for b in last(batches):
            out = []
            for m, i in zip(b.column("marks").to_pylist(), b.column("items").to_pylist()):
                n = int.from_bytes(m[:8], "little")
                hit = int(np.unpackbits(np.frombuffer(m, np.uint8, offset=8)).sum())
                out.append((n, hit, len(i), hashlib.sha256(
                    ",".join(sorted(map(str, i))).encode()).hexdigest(), hit > 0))
            cols = list(zip(*out)) or [()] * 5
            yield pa.record_batch([b.column("doc_id"), *(
                pa.array(c, f.type) for c, f in zip(cols, list(REPORT_ARROW)[1:]))],
                schema=REPORT_ARROW)
    return state.mapInArrow(report, REPORT)


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                        max_windows: int = 500_000, spans_only: bool = False) -> DataFrame:
    """The documents without those that hold a benchmark window; with
    ``spans_only`` every document, its marked words cut from the text instead."""
    spark = docs.sparkSession
    n_blocks, blocks = window_sets(benchmark, width, max_windows)
    schema, carried = docs.schema, spans_only and n_blocks > 1
    if carried:      # marks of all blocks are made on the unchanged text
        name = "marks"
        while name in map(str.lower, docs.columns):
            name += "_"
        docs = docs.withColumn(name, F.lit(None).cast("binary"))
    for k in range(n_blocks):
        held, last = spark.sparkContext.broadcast(next(blocks)), k == n_blocks - 1

        def run(batches, held=held, last=last):
            for b in batches:
                texts = b.column("text")
                marks = [m for _, m, _ in held.value.marks(texts)]
                if not spans_only:
                    yield b.filter(pa.array([not m.any() for m in marks], pa.bool_()))
                    continue
                if carried:
                    at = len(b.schema) - 1
                    marks = [m if old is None else m | np.unpackbits(
                        np.frombuffer(old, np.uint8), count=len(m)).astype(bool)
                        for m, old in zip(marks, b.column(at).to_pylist())]
                    if not last:
                        yield b.set_column(at, b.schema.field(at), pa.array(
                            [np.packbits(m).tobytes() for m in marks], b.schema.field(at).type))
                        continue
                    b = b.remove_column(at)
                new = [t if not m.any() else _cut(t, m) for t, m in zip(texts.to_pylist(), marks)]
                at = b.schema.get_field_index("text")
                yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
        docs = docs.mapInArrow(run, schema if last else docs.schema)
        if not last:     # a worker holds one block, not those of all passes
            docs = cut_lineage(docs)
            held.unpersist()
    return docs


def _cut(text: str, marked: np.ndarray) -> str:
    """The text without the runs of marked words; what stands between them stays."""
    raw = np.frombuffer(text.encode(), np.uint8)
    s, e, _ = spans(LOWER[raw], np.array([0, len(raw)]), NON_ALNUM)
    gone = np.zeros(len(raw) + 1, np.int64)
    i = 0
    while i < len(s):
        if not marked[i]:
            i += 1
            continue
        j = i
        while j + 1 < len(s) and marked[j + 1]:
            j += 1
        gone[s[i]] += 1
        gone[e[j]] -= 1
        i = j + 1
    return raw[np.cumsum(gone)[:-1] == 0].tobytes().decode()
