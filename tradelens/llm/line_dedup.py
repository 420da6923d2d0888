"""Line dedup by overlapping three-line windows.

The lines of a text are its ``\\n``-separated parts (an empty text has none).
Every ``width`` consecutive lines of a document are hashed as one window; a
window whose lines occurred before, that is at a smaller (``doc_id``, line
number), is a repeat, and all lines covered by repeats go. Windows overlap, so a
repeated passage of any length from ``width`` lines on goes whole, while the
first occurrence, and shorter coincidences, stay.

Plan: documents are dealt into slices by hash once; each slice reports its
distinct windows (96 bits and the bucket) with their first place in a packed
exchange (see ``packed``) and learns by one bit each whether an earlier place
exists; the second pass over the same shuffled documents cuts the lines. A
passage that a third of all documents share arrives once per slice.

Defined cases: null text has no lines and stays null; a document of fewer lines
than ``width`` keeps all; a row with a null ``doc_id`` takes no part; two rows
with one ``doc_id`` share their places, so equal rows do not remove each other;
an empty table gives no rows; other columns are carried unchanged, but for
``n_chars``, which follows the text.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed as P
from .textscan import line_spans, window_hash

WIDTH = 3
REPORT = "doc_id long, n_lines long, n_removed long, kept_sha256 string"
REPORT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_lines", pa.int64()),
                          ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def _windows(t: pa.Table, width: int):
    """The slice's windows sorted by hash and place; first of each distinct one."""
    s = P.Units(t, line_spans)
    at = s.starts(width)
    a = window_hash(s.hashes, width)[at]
    b = (window_hash(s.hashes, width, seed=1)[at] >> np.uint64(32)).astype(np.uint32)
    ids, line = s.ids[s.row[at]], at - s.off[s.row[at]]
    order = np.lexsort((line, ids, b, a))
    a, b, at, ids, line = a[order], b[order], at[order], ids[order], line[order]
    return s, a, b, at, ids, line, P.run_starts(a, b)


def _report_pass(buckets, width):
    def run(key, t):
        _, a, b, _, ids, line, first = _windows(t, width)
        a, b, ids, line = a[first], b[first], ids[first], line[first].astype(np.uint32)
        low, cut = a.astype(np.uint32), P.bounds(a, buckets)
        return P.rows([(k, key[0].as_py(), P.ENTRIES, int(y - x),
                        low[x:y].tobytes() + b[x:y].tobytes(), ids[x:y].tobytes(),
                        line[x:y].tobytes())
                       for k, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x])
    return run


def _match(key, t):
    """Which entries have an earlier place in another slice."""
    rs = t.to_pylist()
    h = [np.frombuffer(r["a"], np.uint32).reshape(2, -1).astype(np.uint64) for r in rs]
    h = np.concatenate([x[0] << np.uint64(32) | x[1] for x in h])
    ids = np.concatenate([np.frombuffer(r["b"], np.int64) for r in rs])
    line = np.concatenate([np.frombuffer(r["c"], np.uint32) for r in rs])
    order = np.lexsort((line, ids, h))
    first = P.run_starts(h[order])
    lead = np.repeat(order[first], np.diff(np.append(first, len(h))))
    out = np.empty(len(h), bool)
    out[order] = (ids[lead] != ids[order]) | (line[lead] != line[order])
    return P.reply(rs, out)


def _removed(t: pa.Table, got: pa.Table, width: int):
    """Per line of the slice (in order) whether it goes, and the rows' offsets."""
    s, _, _, at, ids, line, first = _windows(t, width)
    bits = P.answers(got)
    if bits is None:
        return np.zeros(len(s.hashes), bool), s.off
    size = np.diff(np.append(first, len(at)))
    later = (ids != np.repeat(ids[first], size)) | (line != np.repeat(line[first], size))
    return P.covered(at[np.repeat(bits, size) | later], width, len(s.hashes)), s.off


def _kept(t: pa.Table, got: pa.Table, width: int):
    """(text or null, number of lines, lines removed) of every row."""
    gone, off = _removed(t, got, width)
    for i, text in enumerate(t.column("text").to_pylist()):
        g = gone[off[i]:off[i + 1]]
        if g.any():
            yield "\n".join(compress(text.split("\n"), ~g)), len(g), int(g.sum())
        else:
            yield text, len(g), 0


def _passes(docs: DataFrame, width: int, slices, buckets, rest: bool, last, schema):
    slices, buckets = P.sizes(docs, slices, buckets)
    d = P.with_slice(docs, slices, rest).groupBy("slice")
    found = d.applyInArrow(_report_pass(buckets, width), P.ROW).groupBy(
        "bucket").applyInArrow(_match, P.ROW)
    return d.cogroup(found.groupBy("slice")).applyInArrow(last, schema)


def line_dedup(docs: DataFrame, width: int = WIDTH, slices: int | None = None,
               buckets: int | None = None) -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (kept lines joined by ``\\n``) per document."""
    def last(key, t, got):
        t = P.in_order(t)
        out = [(n, gone, hashlib.sha256((text or "").encode()).hexdigest())
               for text, n, gone in _kept(t, got, width)] if t.num_rows else []
        cols = list(zip(*out)) or [()] * 3
        return pa.Table.from_arrays([t.column("doc_id").combine_chunks(), *(
            pa.array(c, f.type) for c, f in zip(cols, list(REPORT_ARROW)[1:]))], schema=REPORT_ARROW)
    return _passes(docs, width, slices, buckets, False, last, REPORT)


def remove_repeated_lines(docs: DataFrame, width: int = WIDTH, slices: int | None = None,
                          buckets: int | None = None) -> DataFrame:
    """The documents, with all their columns, without repeated lines."""
    names = docs.columns

    def last(key, t, got):
        t = P.in_order(t)
        text = pa.array([x for x, _, _ in _kept(t, got, width)] if t.num_rows else [], pa.string())
        rest = t.column("rest").combine_chunks()
        return pa.Table.from_arrays([text if c == "text" else rest.field(c) for c in names],
                                    names=names)
    out = _passes(docs, width, slices, buckets, True, last, docs.schema)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).otherwise(
        F.col("n_chars")).cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


ORACLE_SQL = """
with l as (
  select doc_id, doc_id as r, coalesce(text, '') as text,
         case when text <> '' then string_split(text, chr(10)) else [] end as ls
  from documents
), w as (
  select doc_id, r, unnest(range(1, len(ls) - 1)) as i, ls from l
), h as (
  select doc_id, r, i, md5(ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2]) as k from w
  where doc_id is not null
), f as (
  select k, min(doc_id) as d, arg_min(i, (doc_id, i)) as j from h group by k
), bad as (
  select h.r, flatten(list([i, i + 1, i + 2])) as gone from h join f using (k)
  where h.doc_id > f.d or (h.doc_id = f.d and h.i > f.j) group by h.r
)
select l.doc_id, cast(len(ls) as bigint) as n_lines,
  cast(len(ls) - len(kept) as bigint) as n_removed,
  sha256(array_to_string(kept, chr(10))) as kept_sha256
from (select l.*, case when gone is null then ls else
        [ls[x] for x in range(1, len(ls) + 1) if not list_contains(gone, x)]
      end as kept
      from l left join bad using (r)) l
"""
