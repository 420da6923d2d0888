"""Substring dedup by fixed-block anchors.

A passage is a run of ``width`` consecutive words. Every document's
non-overlapping blocks of ``width // 2`` words are the index (any window of
``width`` words holds a whole block of the text it repeats); every rolling
window of the same length of every document probes it. Around the hits the
``width``-word windows are compared across the corpus and the matching ones are
extended to maximal exact repeats: the union of consecutive matching windows.
A word is removed if a window over it also starts in a document with a smaller
``doc_id``.

Plan: documents are hash-dealt into slices once; three passes read that one
exchange (anchors, windows around hits, removal) and two packed exchanges of
hashes (see ``packed``) carry index and probes. Anchors travel as 32 bits plus
the bucket (a false hit only costs a comparison of windows); windows as 96 bits
plus the bucket. No pairs of documents are formed: a passage shared by N
documents arrives once per slice and keeps only its smallest ``doc_id``.

Defined cases: null text has no words; a document shorter than ``width`` keeps
everything; a row with a null ``doc_id`` takes no part (nothing is removed from
it or because of it); rows that share a ``doc_id`` do not remove each other;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed as P
from .textscan import SPACE, spans, window_hash

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"
RESULT_TEXT = RESULT + ", kept_text string"


class _Slice(P.Units):
    """The words of one slice, as arrays over all its documents."""

    def __init__(self, t: pa.Table):
        super().__init__(t, lambda buf, off: spans(buf, off, SPACE))
        self.words = self.hashes

    def anchors(self, block: int):
        """Distinct rolling block hashes: (positions by hash, run starts, hashes)."""
        at = self.starts(block)
        h = window_hash(self.words, block)[at]
        order = np.argsort(h)
        h, at = h[order], at[order]
        first = P.run_starts(h)
        return at, first, h[first]


def _windows(s: _Slice, at: np.ndarray, width: int):
    """Distinct window hashes at the given starts, with the smallest id of each."""
    a = window_hash(s.words, width)[at]
    b = (window_hash(s.words, width, seed=1)[at] >> np.uint64(32)).astype(np.uint32)
    order = np.lexsort((b, a))
    a, b, at = a[order], b[order], at[order]
    first = P.run_starts(a, b)
    ids = s.ids[s.row[at]]
    least = np.minimum.reduceat(ids, first) if len(first) else ids[:0]
    return at, first, a[first], b[first], ids, least


def _anchor_pass(slices, buckets, block):
    def run(key, t):
        s = _Slice(t)
        at, first, h = s.anchors(block)
        if not len(first):
            return P.rows([])
        index = np.logical_or.reduceat((at - s.off[s.row[at]]) % block == 0, first)
        many = np.minimum.reduceat(s.row[at], first) != np.maximum.reduceat(s.row[at], first)
        low, cut = h.astype(np.uint32), P.bounds(h, buckets)
        return P.rows([(k, key[0].as_py(), P.ENTRIES, int(y - x), low[x:y].tobytes(),
                        P.pack_bits(index[x:y]), P.pack_bits(many[x:y]))
                       for k, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x])
    return run


def _anchor_match(key, t):
    """Which entries are in the index and occur in more than one document."""
    rs = t.to_pylist()
    h = np.concatenate([np.frombuffer(r["a"], np.uint32) for r in rs])
    index = np.concatenate([P.unpack_bits(r["b"], r["n"]) for r in rs])
    many = np.concatenate([P.unpack_bits(r["c"], r["n"]) for r in rs])
    order = np.argsort(h)
    first = P.run_starts(h[order])
    size = np.diff(np.append(first, len(h)))
    hit = (np.logical_or.reduceat(many[order], first) | (size > 1)) \
        & np.logical_or.reduceat(index[order], first)
    out = np.empty(len(h), bool)
    out[order] = np.repeat(hit, size)
    return P.reply(rs, out)


def _window_pass(buckets, block, width):
    def run(key, t, got):
        bits = P.answers(got)
        if not t.num_rows or bits is None or not bits.any():
            return P.rows([])
        s, me = _Slice(t), key[0].as_py()
        at, first, _ = s.anchors(block)
        hits = np.zeros(len(s.words) + 1, np.int64)
        hits[1 + at] = np.repeat(bits, np.diff(np.append(first, len(at))))
        hits = np.cumsum(hits)
        w = s.starts(width)
        w = w[hits[w + width - block + 1] > hits[w]]
        if not len(w):
            return P.rows([])
        mask = np.zeros(len(s.words), bool)
        mask[w] = True
        _, _, a, b, _, least = _windows(s, w, width)
        low, cut, out = a.astype(np.uint32), P.bounds(a, buckets), []
        for k, (x, y) in enumerate(zip(cut[:-1], cut[1:])):
            if y > x:
                ids, ord_ = np.unique(least[x:y], return_inverse=True)
                small = np.uint16 if len(ids) < 65536 else np.uint32
                out.append((k, me, P.ENTRIES, int(y - x), low[x:y].tobytes() + b[x:y].tobytes(),
                            ids.tobytes(), ord_.astype(small).tobytes()))
        out.append((me % buckets, me, P.PASS, len(mask), P.pack_bits(mask), None, None))
        return P.rows(out)
    return run


def _window_match(key, t):
    """Which entries occur under a smaller doc_id than the slice's smallest."""
    rs = [r for r in t.to_pylist() if r["kind"] == P.ENTRIES]
    notes = t.filter(pa.compute.equal(t.column("kind"), P.PASS))
    if not rs:
        return notes
    key_, ids = [], []
    for r in rs:
        x = np.frombuffer(r["a"], np.uint32).reshape(2, -1).astype(np.uint64)
        key_.append(x[0] << np.uint64(32) | x[1])
        table = np.frombuffer(r["b"], np.int64)
        ids.append(table[np.frombuffer(r["c"], np.uint16 if len(table) < 65536 else np.uint32)])
    k, ids = np.concatenate(key_), np.concatenate(ids)
    order = np.argsort(k)
    first = P.run_starts(k[order])
    least = np.minimum.reduceat(ids[order], first)
    out = np.empty(len(k), bool)
    out[order] = np.repeat(least, np.diff(np.append(first, len(k)))) < ids[order]
    return pa.concat_tables([P.reply(rs, out), notes])


def _removal_pass(width, keep_text):
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                        ("kept_sha256", pa.string())]
                       + ([("kept_text", pa.string())] if keep_text else []))

    def run(key, t, got):
        if not t.num_rows:
            return schema.empty_table()
        t = P.in_order(t)
        mask = P.answers(got, P.PASS)
        gone = None
        if mask is not None:
            s = _Slice(t)
            w = np.flatnonzero(mask)
            at, first, _, _, ids, least = _windows(s, w, width)
            size = np.diff(np.append(first, len(at)))
            bad = at[np.repeat(P.answers(got), size) | (ids > np.repeat(least, size))]
            gone = P.covered(bad, width, len(s.words))
        out = []
        for i, text in enumerate(t.column("text")):
            words = (text.as_py() or "").encode().split()
            kept = words
            if gone is not None and (g := gone[s.off[i]:s.off[i + 1]]).any():
                kept = list(compress(words, ~g))
            kept_text = b" ".join(kept)
            out.append((len(words), len(words) - len(kept), hashlib.sha256(kept_text).hexdigest())
                       + ((kept_text.decode(),) if keep_text else ()))
        return pa.Table.from_arrays(
            [t.column("doc_id").combine_chunks(), *(pa.array(c, f.type) for c, f in zip(zip(*out), list(schema)[1:]))],
            schema=schema)
    return run


def substring_dedup(docs: DataFrame, width: int = 50, keep_text: bool = False,
                    slices: int | None = None, buckets: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) per document.

    ``slices`` and ``buckets`` follow the measured size of the texts (``packed.sizes``).
    """
    (slices, buckets), block = P.sizes(docs, slices, buckets), width // 2
    d = P.with_slice(docs, slices)

    def by_slice(df):
        return df.groupBy("slice")

    probes = by_slice(d).applyInArrow(_anchor_pass(slices, buckets, block), P.ROW)
    hits = probes.groupBy("bucket").applyInArrow(_anchor_match, P.ROW)
    windows = by_slice(d).cogroup(by_slice(hits)).applyInArrow(
        _window_pass(buckets, block, width), P.ROW)
    repeats = windows.groupBy("bucket").applyInArrow(_window_match, P.ROW)
    return by_slice(d).cogroup(by_slice(repeats)).applyInArrow(
        _removal_pass(width, keep_text), RESULT_TEXT if keep_text else RESULT)
