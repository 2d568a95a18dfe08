"""Anchors: the few positions at which repeated passages are compared.

Every window of L symbols gets one anchor inside it, the leftmost smallest
hash among its short grams (a minimizer), so equal windows have equal anchors
at equal offsets, and only about one position in L/2 needs to be compared.
``repeated_anchors`` finds the anchors whose gram stands in two documents or
more: one shuffle of eight packed bytes per anchor, no text.

A gram held by many documents of a task is settled inside the task (only one
stand-in travels), so a passage found everywhere costs each reducer at most
one row per map task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kpiloom.llm.arrays import U64, column_bytes, group_edges, mix, slices
from kpiloom.llm.tables import bucket_of, by_bucket, by_document, document_blocks, join_blocks, pack, partitions

FLUSH = 1_000_000          # anchors settled together inside a map task
SEVERAL = -2**63           # document mark of a gram known to stand in several


def inside_task(grams: np.ndarray, ids: np.ndarray, positions: np.ndarray, n: int):
    """Settle what one task can: yields (bucket, block) rows.

    A block holds the open anchors (32 hash bits, id, position) and known
    repeated ones (id, position), the latter dealt by document.
    """
    order = np.argsort(grams, kind="stable")
    g, i = grams[order], ids[order]
    edges = group_edges(g)
    size = np.diff(np.append(edges, len(g)))
    known = np.minimum.reduceat(i, edges) != np.maximum.reduceat(i, edges)
    is_known = np.empty(len(g), bool)
    is_known[order] = np.repeat(known, size)    # in document order, where neighbours compress
    marks = int(known.sum())
    open_g = np.concatenate([grams[~is_known], g[edges[known]]])
    open_i = np.concatenate([ids[~is_known], np.full(marks, SEVERAL)])
    open_p = np.concatenate([positions[~is_known], np.zeros(marks, positions.dtype)])
    rows = {b: x for b, x in by_bucket(bucket_of(open_g, n), open_g.astype(np.uint32), open_i, open_p)}
    i, p = ids[is_known], positions[is_known]
    there = {b: x for b, x in by_bucket(bucket_of(mix(i.astype(U64)), n), i, p)}
    none = [np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, positions.dtype)]
    for b in sorted({*rows, *there}):
        yield b, pack(*rows.get(b, none), *there.get(b, none[1:]))


def repeated_anchors(docs: DataFrame, find: Callable) -> DataFrame:
    """(id, positions): the anchors whose gram stands in at least two documents.

    ``docs`` has (id, text); ``find(data, offsets)`` gives (64-bit gram hash,
    document, position in the document) of a slice's anchors.  A rare hash
    clash only adds a candidate, which the comparison of the text then drops.
    """
    n = partitions(docs.sparkSession)

    def deal(batches):
        held, have = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            data, offsets = column_bytes(batch.column(1))
            for i, j in slices(offsets):
                grams, doc, pos = find(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                held.append((grams, ids[i:j][doc], pos.astype(np.uint32)))
                have += len(grams)
                if have >= FLUSH:
                    yield from flush(held)
                    held, have = [], 0
        if have:
            yield from flush(held)

    def flush(held):
        rows = [*inside_task(*(np.concatenate(x) for x in zip(*held)), n)]
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()),
                                          pa.array([x for _, x in rows], pa.binary())], names=["bucket", "block"])

    def meet(batches):
        blocks = [(b.column(0)[k].as_py(), b.column(1)[k].as_py()) for b in batches for k in range(b.num_rows)]
        if not blocks:
            return
        grams, ids, pos, known_ids, known_pos = join_blocks([x for _, x in blocks])
        ids, pos = [known_ids, ids], [known_pos, pos]
        order = np.argsort(grams, kind="stable")
        g, i = grams[order], ids[1][order]
        edges = group_edges(g)
        if len(edges):
            several = np.minimum.reduceat(i, edges) != np.maximum.reduceat(i, edges)
            keep = np.repeat(several, np.diff(np.append(edges, len(g)))) & (i != SEVERAL)
            ids[1], pos[1] = i[keep], pos[1][order][keep]
        else:
            ids[1], pos[1] = ids[1][:0], pos[1][:0]
        yield document_blocks(n, np.concatenate(ids), np.concatenate(pos))

    dealt = docs.select("id", "text").mapInArrow(deal, "bucket int, block binary").repartitionById(n, "bucket")
    return by_document(dealt.mapInArrow(meet, "bucket int, block binary"), n, "positions")


def chosen(first_in_doc: np.ndarray, doc: np.ndarray, positions: pa.ListArray) -> np.ndarray:
    """Which anchors (document, position) are among the documents' listed positions."""
    flat = positions.flatten().to_numpy()
    size = np.diff(positions.offsets.to_numpy())
    owner = np.repeat(np.arange(len(size)), size)
    listed = np.unique((owner.astype(U64) << U64(40)) | flat.astype(U64))
    wanted = (doc.astype(U64) << U64(40)) | first_in_doc.astype(U64)
    at = np.searchsorted(listed, wanted)
    return (at < len(listed)) & (listed[np.minimum(at, max(len(listed) - 1, 0))] == wanted) if len(listed) \
        else np.zeros(len(wanted), bool)
