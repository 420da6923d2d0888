"""Word and line scanning of Arrow text columns with numpy, inside tasks.

Texts of a batch are processed in runs of about ``RUN_BYTES`` so the working
memory of a task follows the run (or the longest single text), not the batch.
Everything here is per-text; nothing knows about Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 1 << 20

# ASCII white space; every other byte belongs to a word
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
# everything but digits, a-z and non-ASCII (applied after lower-casing A-Z)
NON_ALNUM = np.ones(256, bool)
NON_ALNUM[0x30:0x3A] = False
NON_ALNUM[0x61:0x7B] = False
NON_ALNUM[0x80:] = False
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BYTE = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xD6E8FEB86659FD93)
_JOIN = np.uint64(0xA0761D6478BD642F)
_S = np.uint64(32)
_pow: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the odd step and of its inverse modulo 2**64."""
    global _pow
    if len(_pow[0]) < n:
        _pow = []
        for x in (_STEP, pow(_STEP, -1, 2**64)):
            p = np.full(n, x, np.uint64)
            p[0] = 1
            _pow.append(np.multiply.accumulate(p))
    return _pow


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    h = h ^ (h >> _S)
    h = h * _MIX
    h ^= h >> _S
    h *= _MIX
    h ^= h >> _S
    return h


def join_hash(a: np.ndarray, b: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of the concatenation of two hashed sequences of fixed lengths."""
    h = a * _JOIN
    h ^= h >> _S
    h += b
    h *= _MIX + np.uint64(2 * seed)
    h ^= h >> _S
    return h


def window_hash(h: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of every ``width`` consecutive entries of ``h`` (one per start).

    Built by doubling, so the cost is about ``2 log2(width)`` vector passes.
    """
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, at, power, size = None, 0, h, 1
    while True:
        if width & size:
            part = power[at:at + n]
            out = part if out is None else join_hash(out, part, seed)
            at += size
        if size * 2 > width:
            return out if width > 1 else mix(out)
        power = join_hash(power[:-size], power[size:], seed)
        size *= 2


def runs(texts: pa.Array, run_bytes: int = RUN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) for runs of rows; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + run_bytes, side="right")) - 1)
        yield i, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def spans(buf: np.ndarray, off: np.ndarray, sep: np.ndarray):
    """Word spans: (start, end, words per row as offsets). Words never cross rows."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    w = ~sep[buf]
    first = w.copy()
    first[1:] &= ~w[:-1]
    last = w.copy()
    last[:-1] &= ~w[1:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    first[cut] = w[cut]
    last[cut - 1] = w[cut - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, off)


def line_spans(buf: np.ndarray, off: np.ndarray):
    """Spans of the ``\\n``-separated lines of every row, empty lines included.

    A row without bytes has no line; a break on the last byte opens an empty line.
    """
    nl = np.flatnonzero(buf == 0x0A)
    full = off[1:] > off[:-1]
    start = np.sort(np.concatenate([off[:-1][full], nl + 1]))
    end = np.sort(np.concatenate([off[1:][full], nl]))
    per_row = np.diff(np.searchsorted(nl, off)) + full
    return start, end, np.concatenate([[0], np.cumsum(per_row)])


def byte_sums(buf: np.ndarray) -> np.ndarray:
    """Running sums of the bytes times the powers of the step, for ``sums_hash``."""
    c = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * _powers(max(len(buf) + 1, RUN_BYTES + 1))[0][:len(buf)], out=c[1:])
    return c


def sums_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``span_hash`` from running sums that several hashings share."""
    down = _powers(max(len(sums), RUN_BYTES + 1))[1]
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * _JOIN)


def span_hash(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every byte span (differences of one running sum)."""
    if not len(start):
        return np.zeros(0, np.uint64)
    up, down = _powers(max(len(buf) + 1, RUN_BYTES + 1))
    c = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * up[:len(buf)], out=c[1:])
    return mix((c[end] - c[start]) * down[start] + (end - start).astype(np.uint64) * _JOIN)
