"""A packed exchange of hashes between slices of documents and hash buckets.

Operators that must meet every word position of the corpus with every other
(repeated passages, shared shingles) would emit one row per position. Here a
task reduces its *slice* of the documents to its distinct hashes and sends one
binary row per (slice, hash bucket); a bucket task compares the rows of all
slices and answers each with one bit per entry. So

* a hash that fills a third of the corpus still arrives once per slice,
* rows in the shuffle number slices x buckets, not positions,
* answers cost one bit, since a slice can rebuild its entries in the same order.

Slices are hash partitions of the documents; the same shuffled documents feed
every pass of a query (one exchange, reused).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textscan import runs, span_hash

ROW = "bucket int, slice int, kind int, n int, a binary, b binary, c binary"
ROW_ARROW = pa.schema([("bucket", pa.int32()), ("slice", pa.int32()), ("kind", pa.int32()),
                       ("n", pa.int32()), ("a", pa.binary()), ("b", pa.binary()),
                       ("c", pa.binary())])
ENTRIES, PASS = 0, 1   # kinds of rows: entries to compare, notes of a slice to itself


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


SLICE_BYTES = 64 << 20    # text of a slice
BUCKET_BYTES = 128 << 20  # text whose hashes (about 4 bytes a word) meet in a bucket


def sizes(docs: DataFrame, slices: int | None, buckets: int | None) -> tuple[int, int]:
    """Numbers of slices and buckets: by the measured size of all texts, but at
    least twice and once the session's shuffle partitions, so that tasks stay
    small whatever that setting is."""
    n = shuffle_partitions(docs.sparkSession)
    if not (slices and buckets):
        size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
        slices = slices or max(2 * n, -(-size // SLICE_BYTES))
        buckets = buckets or max(n, -(-size // BUCKET_BYTES))
    return slices, buckets


def with_slice(docs: DataFrame, slices: int, rest: bool = False) -> DataFrame:
    """doc_id, text and the slice; a hash of both spreads null or repeated ids.

    ``rest`` adds all other columns in one struct, where no name can clash.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        *([F.struct(*others).alias("rest")] if rest else []),
        F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.col("text")), F.lit(slices))
        .cast("int").alias("slice"))


def in_order(t: pa.Table) -> pa.Table:
    """The rows of a slice in an order that does not depend on the shuffle."""
    return t.sort_by([("doc_id", "ascending"), ("text", "ascending")]) if t.num_rows else t


class Units:
    """The units (words, lines) of the rows of a slice, as arrays over all rows.

    ``cut(bytes, offsets)`` gives unit starts, ends and counts per row as offsets.
    """

    def __init__(self, t: pa.Table, cut):
        t = in_order(t)
        ids = t.column("doc_id")
        self.live = ids.is_valid().to_numpy()
        self.ids = ids.fill_null(0).to_numpy()
        hashes, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, buf, off in runs(t.column("text")):
            s, e, n = cut(buf, off)
            hashes.append(span_hash(buf, s, e))
            counts.append(np.diff(n))
        self.hashes = np.concatenate(hashes)
        self.count = np.concatenate(counts)
        self.off = np.concatenate([[0], np.cumsum(self.count)])
        self.row = np.repeat(np.arange(len(self.count)), self.count)

    def starts(self, width: int) -> np.ndarray:
        """Positions where a window of ``width`` units of one row with an id starts."""
        ok = np.arange(len(self.hashes)) + width <= self.off[1:][self.row]
        return np.flatnonzero(ok & self.live[self.row])


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    edge[starts] += 1
    edge[starts + width] -= 1
    return np.cumsum(edge)[:-1] > 0


def reply(rs: list[dict], bits: np.ndarray) -> pa.Table:
    """One answer row per entry row, a bit per entry."""
    cut = np.cumsum([0] + [r["n"] for r in rs])
    return rows([(r["bucket"], r["slice"], ENTRIES, r["n"], pack_bits(bits[x:y]), None, None)
                 for r, x, y in zip(rs, cut[:-1], cut[1:])])


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Monotone in ``h``, so sorted hashes have contiguous buckets."""
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def bounds(h_sorted: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(bucket_of(h_sorted, buckets), np.arange(buckets + 1))


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """First positions of the runs of equal key tuples in sorted arrays."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def rows(records: list[tuple]) -> pa.Table:
    return pa.Table.from_pylist([dict(zip(ROW_ARROW.names, r, strict=True)) for r in records],
                                schema=ROW_ARROW)


def pack_bits(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def unpack_bits(b: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool)


def answers(t: pa.Table, kind: int = ENTRIES) -> np.ndarray | None:
    """The bits a slice got back, concatenated in bucket order."""
    if not t.num_rows:
        return None
    got = sorted((r["bucket"], r["n"], r["a"]) for r in t.select(["bucket", "kind", "n", "a"])
                 .to_pylist() if r["kind"] == kind)
    return np.concatenate([unpack_bits(a, n) for _, n, a in got]) if got else None
