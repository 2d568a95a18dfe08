"""Repeated windows of L symbols across documents: the steps shared by the
byte operator (suffix arrays) and the word operator (suffix trees).

1. Windows whose anchor gram stands in two documents or more are found
   (``anchors``); the candidate table is stored.
2. The text, joined with its candidates, gives blocks of symbols around each
   candidate.  A map task settles its own blocks: every copy except those of
   its smallest document is decided there.
3. Open blocks are dealt to buckets by their leading symbols, as the
   operator's method says, and compared there with the blocks of other tasks.
4. Decided spans go back to their documents.

A *kind* tells how text becomes symbols: ``length``; ``anchors(data,
offsets)`` -> (symbols, symbols before each document, gram hash, document,
anchor, first window, last window); ``codes`` (64-bit codes for hashing);
``gram(body, at)``; ``smallest_holder(body, at, ids)``; and the dealing:
``leads(body, at)`` (sampled rows), ``plan(DataFrame, n)`` and ``deal(plan,
body, at, n)``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.anchors import chosen, repeated_anchors
from kpiloom.llm.arrays import U64, column_bytes, group_edges, merge_spans, mix, slices, span_hashes
from kpiloom.llm.tables import (bucket_of, by_bucket, by_document, document_blocks, join_blocks, pack, partitions,
                                stored)

BLOCK_BYTES = 4 << 20      # block symbols settled together inside a map task
CHUNK = 1 << 19            # symbols hashed or copied, and windows compared, at a time
SAMPLE_ONE_IN = 16         # documents, and of those the anchors, sampled for the dealing (balance only)


def window_starts(offsets: np.ndarray, length: int) -> np.ndarray:
    """Whether a window of ``length`` symbols of one document starts at each symbol."""
    outside = np.zeros(int(offsets[-1]) + 1, np.int32)
    np.add.at(outside, np.maximum(offsets[:-1], offsets[1:] - length + 1), 1)
    np.add.at(outside, offsets[1:], -1)
    return np.cumsum(outside[:-1]) == 0


def settle(kind, body: np.ndarray, start: np.ndarray, anchor: np.ndarray, windows: np.ndarray, ids: np.ndarray):
    """Compare blocks of symbols around anchors.

    Block b holds ``windows[b]`` windows from ``start[b]`` on in ``body``.
    Returns (block, from, to) spans, relative to their block, covered by
    windows that a smaller id holds too; and per block whether some window is
    still without a smaller holder.
    """
    n, length = len(start), kind.length
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, bool)
    key = block_hashes(kind, body, start, windows + length - 1)
    key ^= mix(anchor.astype(U64) << U64(32) | windows.astype(U64))
    order = np.lexsort((ids, key))
    edges = group_edges(key[order])
    group = np.empty(n, np.int64)
    group[order] = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, n)))
    stand = order[edges]                        # one block for all equal ones, of the smallest id
    least = ids[stand]
    later = ids > least[group]                  # an equal block stands in a smaller document
    # blocks around the same gram are compared window by window where they differ
    gram = kind.gram(body, start[stand] + anchor[stand])
    o = np.argsort(gram, kind="stable")
    e = group_edges(gram[o])
    mixed = np.minimum.reduceat(least[o], e) != np.maximum.reduceat(least[o], e)
    some = o[np.repeat(mixed, np.diff(np.append(e, len(o))))]
    open_ = np.ones(len(stand), bool)
    found = [(some[:0], some[:0], some[:0])]
    for mine in gram_ranges(some, gram, windows[stand]):
        # runs of held windows of each compared block
        nw = windows[stand[mine]]
        of = np.repeat(np.arange(len(mine)), nw)
        off = np.arange(len(of)) - np.repeat(np.cumsum(nw) - nw, nw)
        own = least[mine][of]
        held = kind.smallest_holder(body, start[stand[mine]][of] + off, own) < own
        other = of[1:] != of[:-1]
        run = np.flatnonzero(held & np.r_[True, ~held[:-1] | other])
        stop = np.flatnonzero(held & np.r_[~held[1:] | other, True])
        found.append((mine[of[run]], off[run], off[stop] + length))
        open_[mine] = np.bincount(of[~held], minlength=len(mine)) > 0
    span_group, span_from, span_to = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(span_group, kind="stable")
    span_group, span_from, span_to = span_group[order], span_from[order], span_to[order]
    # to every block: whole, or the runs of its group
    first_of = np.flatnonzero(~later)
    by_group = first_of[np.argsort(group[first_of], kind="stable")]
    lo = np.searchsorted(group[by_group], span_group, side="left")
    hi = np.searchsorted(group[by_group], span_group, side="right")
    rep = np.repeat(np.arange(len(span_group)), hi - lo)
    member = by_group[np.repeat(lo, hi - lo) + np.arange(len(rep)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)]
    whole = np.flatnonzero(later)
    return (np.concatenate([whole, member]), np.concatenate([np.zeros(len(whole), np.int64), span_from[rep]]),
            np.concatenate([windows[whole] + length - 1, span_to[rep]]), ~later & open_[group])


def gram_ranges(some: np.ndarray, gram: np.ndarray, windows: np.ndarray):
    """Blocks ``some`` (sorted by gram) in ranges of about CHUNK windows that part no gram."""
    edges = np.append(group_edges(gram[some]), len(some))
    total = np.concatenate([[0], np.cumsum(windows[some])])[edges]
    i = 0
    while i < len(edges) - 1:
        j = max(i + 1, int(np.searchsorted(total, total[i] + CHUNK, side="right")) - 1)
        yield some[edges[i]:edges[j]]
        i = j


def chunks(size: np.ndarray, limit: int = CHUNK):
    """Ranges of blocks with at most ``limit`` symbols together, or one block."""
    total = np.concatenate([[0], np.cumsum(size)])
    i = 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, side="right")) - 1)
        yield i, j
        i = j


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of ``data`` one after another, and where each begins."""
    begin = np.cumsum(size) - size
    out = np.empty(int(size.sum()), data.dtype)
    for i, j in chunks(size):
        at, n = int(begin[i]), int(size[i:j].sum())
        out[at:at + n] = data[np.arange(at, at + n) + np.repeat(start[i:j] - begin[i:j], size[i:j])]
    return out, begin


def block_hashes(kind, body: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each block's symbols; ``start`` rises."""
    out = np.empty(len(start), U64)
    for i, j in chunks(size):
        a, b = int(start[i]), int(start[j - 1] + size[j - 1])
        out[i:j] = span_hashes(kind.codes(body[a:b]), start[i:j] - a, start[i:j] + size[i:j] - a)
    return out


def document_spans(ids: np.ndarray, variant: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Spans of each document merged: columns (id, variant, start, end)."""
    order = np.lexsort((start, variant, ids))
    i, v, s, e = ids[order], variant[order], start[order], end[order]
    edges = group_edges(i, v)
    if not len(edges):
        return i, v, s, e
    # shift documents apart so that one merge serves all
    doc = np.repeat(np.arange(len(edges)), np.diff(np.append(edges, len(i))))
    step = int(e.max()) + 2
    s, e = merge_spans(s + doc * step, e + doc * step)
    doc = s // step
    return i[edges][doc], v[edges][doc], s - doc * step, e - doc * step


def repeated_spans(docs: DataFrame, kind) -> DataFrame:
    """(id, spans): flat triples (variant, start, end) of the symbols to remove.

    ``docs`` has (id, text, variant), see ``tables.keyed``.
    """
    spark, length = docs.sparkSession, kind.length
    n = partitions(spark)

    def find(data, offsets):
        _, off, h, doc, anchor, _, _ = kind.anchors(data, offsets)
        return h, doc, anchor - off[doc]

    found = stored(repeated_anchors(docs, find))

    def blocks(batches):
        """Blocks of symbols around the listed anchors of each slice of documents."""
        for batch in batches:
            ids, variant = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            data, offsets = column_bytes(batch.column(1))
            for i, j in slices(offsets):
                symbols, off, _, doc, anchor, first, last = kind.anchors(data[offsets[i]:offsets[j]],
                                                                         offsets[i:j + 1] - offsets[i])
                keep = chosen(anchor - off[doc], doc, batch.column(3).slice(i, j - i))
                doc, anchor, first, last = doc[keep], anchor[keep], first[keep], last[keep]
                if len(doc):
                    body, begin = gather(symbols, first, last - first + length)
                    yield (body, begin, anchor - first, last - first + 1, ids[i:j][doc], variant[i:j][doc],
                           first - off[doc])

    def together(parts):
        """Several parts as one (block starts shifted)."""
        shift = np.cumsum([0, *(len(p[0]) for p in parts)])
        cols = [np.concatenate(x) for x in zip(*parts)]
        cols[1] = np.concatenate([p[1] + s for p, s in zip(parts, shift)])
        return cols

    def sample(batches):
        for body, begin, anchor, *_ in blocks(batches):
            at = begin + anchor
            at = at[mix(kind.gram(body, at)) % U64(SAMPLE_ONE_IN) == 0]
            yield pa.RecordBatch.from_arrays([pa.array(kind.leads(body, at).tolist(), pa.list_(pa.int64()))],
                                             names=["lead"])

    columns = ["id", "text", "variant", "positions"]
    some = docs.where(F.xxhash64("id", "variant") % SAMPLE_ONE_IN == 0).join(found, "id").select(*columns)
    plan = kind.plan(some.mapInArrow(sample, "lead array<long>"), n)

    def deal(batches):
        held, have = [], 0
        for part in blocks(batches):
            held.append(part)
            have += part[0].nbytes
            if have >= BLOCK_BYTES:
                yield flush(together(held))
                held, have = [], 0
        if held:
            yield flush(together(held))

    def flush(cols):
        body, begin, anchor, windows, ids, variant, first = cols
        block, s, e, still = settle(kind, body, begin, anchor, windows, ids)
        done = document_spans(ids[block], variant[block], first[block] + s, first[block] + e)
        there = dict(by_bucket(bucket_of(mix(done[0].astype(U64)), n), *done))
        o = np.flatnonzero(still)
        rows = dict(by_bucket(kind.deal(plan, body, begin[o] + anchor[o], n), o))
        out = []
        for b in sorted({*rows, *there}):
            mine = rows[b][0] if b in rows else o[:0]
            text, _ = gather(body, begin[mine], windows[mine] + length - 1)
            out.append((b, pack(text, anchor[mine].astype(np.uint8), windows[mine].astype(np.uint8), ids[mine],
                                variant[mine], first[mine], *there.get(b, [x[:0] for x in done]))))
        return pa.RecordBatch.from_arrays([pa.array([b for b, _ in out], pa.int32()),
                                           pa.array([x for _, x in out], pa.binary())], names=["bucket", "block"])

    def meet(batches):
        packed = [b.column(1)[k].as_py() for b in batches for k in range(b.num_rows)]
        if not packed:
            return
        body, anchor, windows, ids, variant, first, *done = join_blocks(packed)
        windows = windows.astype(np.int64)
        size = windows + length - 1
        block, s, e, _ = settle(kind, body, np.cumsum(size) - size, anchor.astype(np.int64), windows, ids)
        new = ids[block], variant[block], first[block] + s, first[block] + e
        yield document_blocks(n, *document_spans(*(np.concatenate(x) for x in zip(done, new))))

    dealt = docs.join(found, "id").select(*columns).mapInArrow(deal, "bucket int, block binary") \
        .repartitionById(n, "bucket")
    return by_document(dealt.mapInArrow(meet, "bucket int, block binary"), n, "spans")


def row_spans(batch: pa.RecordBatch, variant_at: int, spans_at: int):
    """The merged (starts, ends) of each row of a batch: those of its own variant."""
    variant, lists = batch.column(variant_at).to_numpy(), batch.column(spans_at)
    flat = lists.flatten().to_numpy().reshape(-1, 3)
    size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy() // 3
    at = np.concatenate([[0], np.cumsum(size)])
    for k in range(batch.num_rows):
        mine = flat[at[k]:at[k + 1]]
        mine = mine[mine[:, 0] == variant[k]]
        yield merge_spans(mine[:, 1], mine[:, 2])
