"""Operator 1: suffix-array dedup of repeated byte strings.

A byte goes if it is covered by a ``length``-byte string (50) that also starts
in a document with a smaller id; strings are judged on the input.

Which suffixes can matter is found first: every 50-byte window has an anchor
inside it (``anchors``), and only windows whose anchor's 16-byte gram stands
in two documents or more are kept, as short blocks of text around the anchor.
Their suffixes make a distributed suffix array:

* splitters sampled from the repeated anchors' leading bytes range-partition
  the blocks by the gram's first 8 bytes, so suffixes with the same gram meet;
* a bucket sorts its suffixes by multikey quicksort, eight bytes a step, and
  drops a range of equal suffixes as soon as it holds one document only;
* borders: suffixes on the two sides of a splitter differ within 8 bytes, so
  they share no 50-byte string and nothing has to cross.  What a gram shares
  across map tasks meets in its bucket; inside a task all copies but those of
  the task's smallest document are settled at once, and only that one travels.
  A passage in a third of all rows costs a bucket one row per map task.

No pairs are made and nothing is dropped: each window learns the smallest
document that holds it.  The text is shuffled once (by id) and read back for
blocks and for the result; the candidate table is stored, so lost executors
re-read files.

Defined results: null text is the empty text; a null id orders after all
others; rows that share an id never remove each other's bytes (equal is not
smaller); texts under ``length`` bytes and empty texts stay whole; other
columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.arrays import BYTE_CODE, SLICE_BYTES, U64, column_bytes, group_edges, minimizers, mix
from kpiloom.llm.repeats import repeated_spans, row_spans, window_starts
from kpiloom.llm.tables import keyed, original_id

LENGTH = 50
GRAM = 16                  # leading bytes that choose the anchor


def words_at(data: np.ndarray, order: str = ">") -> np.ndarray:
    """The 8 bytes from every position on as one number (a view, no copy); the end reads as zeros."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data),), f"{order}u8", padded.data, 0, (1,))


class Bytes:
    """Text as bytes; suffixes sorted by multikey quicksort in range-partitioned buckets."""

    def __init__(self, length: int):
        self.length = length

    def anchors(self, data, offsets):
        starts_ok = window_starts(offsets, self.length)
        parts = []
        for c in range(0, len(data), SLICE_BYTES):
            sub = data[c:c + SLICE_BYTES + self.length - 1]
            w = words_at(sub, "<").astype(U64)
            h = w[:max(len(w) - 8, 0)] * U64(0x9FB21C651E98DF25) ^ w[8:] * U64(0xC2B2AE3D27D4EB4F)
            h ^= h >> U64(29)
            h *= U64(0x94D049BB133111EB)
            anchor, first, last = minimizers((h >> U64(32)).astype(np.uint32), starts_ok[c:],
                                             self.length - GRAM + 1, self.length)
            parts.append((mix(h[anchor]), anchor + c, first + c, last + c))
        none = np.zeros(0, np.int64)
        h, anchor, first, last = (np.concatenate(x) for x in zip(*parts)) if parts else (none.astype(U64), *[none] * 3)
        return data, offsets, h, np.searchsorted(offsets, first, side="right") - 1, anchor, first, last

    @staticmethod
    def codes(body):
        return BYTE_CODE[body]

    @staticmethod
    def gram(body, at):
        word = words_at(body)
        return mix(word[at].astype(U64)) ^ word[at + 8].astype(U64) * U64(0xC2B2AE3D27D4EB4F)

    def smallest_holder(self, body: np.ndarray, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """For each suffix (at) of ``body``: the smallest id among the suffixes equal to it over
        ``length`` bytes.  Multikey quicksort, all open ranges a step at a time."""
        word, best = words_at(body), ids.copy()
        live, part = np.arange(len(at)), np.zeros(len(at), np.int64)
        for depth in [*range(0, self.length - 7, 8), *([self.length - 8] if self.length % 8 else [])]:
            symbol = word[at[live] + depth].astype(U64)
            order = np.lexsort((symbol, part[live])) if depth else np.argsort(symbol, kind="stable")
            live = live[order]
            edges = group_edges(part[live], symbol[order])
            low, high = np.minimum.reduceat(ids[live], edges), np.maximum.reduceat(ids[live], edges)
            size = np.diff(np.append(edges, len(live)))
            keep = np.repeat(low != high, size)     # a range of one document repeats nothing
            part[live] = np.repeat(np.arange(len(edges)), size)
            low = np.repeat(low, size)[keep]
            live = live[keep]
            if not len(live):
                return best
        best[live] = low
        return best

    @staticmethod
    def leads(body, at):
        return (words_at(body)[at].astype(U64) >> U64(1)).astype(np.int64)[:, None]

    @staticmethod
    def plan(leads: DataFrame, n: int) -> np.ndarray:
        """n - 1 splitters: sampled quantiles of the leading bytes (n numbers on the driver)."""
        if n < 2:
            return np.zeros(0, np.int64)
        cuts = F.percentile_approx(F.col("lead")[0], [i / n for i in range(1, n)], 20 * n)
        return np.unique(np.array(leads.agg(cuts).first()[0] or [], np.int64))

    def deal(self, plan, body, at, n):
        return np.searchsorted(plan, self.leads(body, at)[:, 0], side="right")


def suffix_dedup(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, n_bytes, spans, kept): removed byte spans and the remaining bytes of every row."""
    if not 24 <= length <= 128:
        raise ValueError("length must be 24 to 128 bytes")
    docs = keyed(df, id_col, text_col)
    spans = repeated_spans(docs, Bytes(length))
    both = docs.join(spans, "id", "left").select(original_id(df, id_col), "text", "variant", "spans")

    def cut(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            raw = data.tobytes()
            kept, count, starts, ends = [], [], [], []
            for k, (s, e) in enumerate(row_spans(batch, 2, 3)):
                a, b = offsets[k], offsets[k + 1]
                count.append(len(s))
                starts.append(s)
                ends.append(e)
                border = [0, *np.stack([s, e], axis=1).reshape(-1).tolist(), b - a]
                kept.append(b"".join(raw[a + border[i]:a + border[i + 1]] for i in range(0, len(border), 2)))
            runs = pa.StructArray.from_arrays([pa.array(np.concatenate(starts)), pa.array(np.concatenate(ends))],
                                              names=["start", "end"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)),
                 pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), runs),
                 pa.array(kept, pa.binary())], names=[id_col, "n_bytes", "spans", "kept"])

    kind = df.schema[id_col].dataType.simpleString()
    return both.mapInArrow(cut, f"{id_col} {kind}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
