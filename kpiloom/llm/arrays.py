"""NumPy helpers on the UTF-8 bytes of an Arrow text column.

All work inside one Spark task on one slice of documents at a time; memory is
proportional to a slice (a few megabytes) or to the longest single document.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20      # text processed at a time inside a task
# The white space of every word rule here, 0x20 and 0x09-0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1              # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)


def worker_cache(name: str) -> dict:
    """A dict that lives as long as the Python worker, across its tasks."""
    home = sys.modules.setdefault("_kpiloom_llm_worker", types.ModuleType("_kpiloom_llm_worker"))
    return home.__dict__.setdefault(name, {})


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (xor-shift and odd multipliers)."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=U64))
LOWER_CODE = BYTE_CODE.copy()
LOWER_CODE[ord("A"):ord("Z") + 1] = BYTE_CODE[ord("a"):ord("z") + 1]


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), dtype=U64)
    have, step = 1, base % (1 << 64)
    while have < n:
        take = min(have, n - have)
        out[have:have + take] = out[:take] * U64(step)
        have += take
        step = step * step % (1 << 64)
    return out[:n]


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of a text column; a null counts as the empty text."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    body = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]]
    return body, offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Ranges (i, j) of documents with at most ``limit`` bytes, or one document."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word ``[^\\x20\\x09-\\x0D]+`` and the words before each document."""
    n = len(data)
    if not n:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]      # first bytes of documents with text
    first[at] = inside[at]
    at = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[at] = inside[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers and inverse powers of BASE, kept in the worker up to a slice's length (64 MB at most)."""
    kept = worker_cache("powers")
    if n > len(kept.get("up", ())):
        size = max(n, 1 << 20)
        up, down = powers(size, BASE), powers(size, INVERSE)
        if size > 2 * SLICE_BYTES:
            return up, down
        kept.update(up=up, down=down)
    return kept["up"], kept["down"]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``codes``; equal spans have equal hashes anywhere.

    Polynomial hash from one running sum: sum(code[i] * B**i) over the span,
    divided by B**start, then scrambled with the length.
    """
    n = len(codes)
    up, down = _powers(n)
    total = np.zeros(n + 1, dtype=U64)
    np.cumsum(codes * up[:n], out=total[1:])
    out = (total[ends] - total[starts]) * down[np.minimum(starts, max(n - 1, 0))]
    return mix(out ^ (ends - starts).astype(U64) * U64(0xA0761D6478BD642F))


def word_hashes(data: np.ndarray, offsets: np.ndarray, code: np.ndarray = BYTE_CODE):
    """(hash of every word, words before each document, starts, ends) of a slice."""
    starts, ends, before = word_bounds(data, offsets)
    if not len(starts):
        return np.zeros(0, U64), before, starts, ends
    parts, i = [], 0
    while i < len(starts):              # one slice's worth of bytes, cut between words
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, side="right")))
        a, b = starts[i], ends[j - 1]
        parts.append(span_hashes(code[data[a:b]], starts[i:j] - a, ends[i:j] - a))
        i = j
    return (parts[0] if len(parts) == 1 else np.concatenate(parts)), before, starts, ends


def window_minimum(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling (log2 passes)."""
    out, have = key, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:]) if len(out) > have else out[:0]
        have *= 2
    rest = width - have
    if rest and len(out):
        out = np.minimum(out[:len(out) - rest], out[rest:]) if len(out) > rest else out[:0]
    return out


def minimizers(order: np.ndarray, last_start: np.ndarray, width: int, length: int):
    """Anchors of all windows of ``length`` symbols, each the leftmost smallest
    of the window's ``width`` order values.

    ``order[i]`` (uint32) depends on the ``length - width + 1`` symbols from i
    on; ``last_start[i]`` tells whether a window may start at i.  Equal windows
    get the same anchor offset wherever they stand.  Returns (anchor, first
    window start, last window start) for each maximal run of windows that
    share an anchor.
    """
    n = len(order) - width + 1
    empty = np.zeros(0, np.int64)
    if n <= 0:
        return empty, empty, empty
    key = (order.astype(U64) << U64(32)) | np.arange(len(order), dtype=U64)
    low = window_minimum(key, width).astype(np.uint32).astype(np.int64)
    low[~last_start[:n]] = -1
    cut = np.flatnonzero(np.diff(low, prepend=-2, append=-2))
    first, last = cut[:-1], cut[1:] - 1
    anchor = low[first]
    real = anchor >= 0
    return anchor[real], first[real], last[real]


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as maximal runs (touching spans join)."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.flatnonzero(np.r_[True, s[1:] > e[:-1]])
    return s[new], e[np.r_[new[1:] - 1, len(e) - 1]]


def group_edges(*keys: np.ndarray) -> np.ndarray:
    """First positions of the runs of equal rows in sorted key columns."""
    n = len(keys[0])
    if not n:
        return np.zeros(0, np.int64)
    new = np.zeros(n, dtype=bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)
