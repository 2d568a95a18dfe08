"""Operator 5: substring dedup of word sequences by prefix-partitioned suffix trees.

A window is ``length`` consecutive words (50) of one document; a word goes if
a window that covers it also starts in a document with a smaller id.  Words
are ``[^\\x20\\x09-\\x0D]+``, compared as 64-bit hashes.

The suffixes that can matter are found first (``repeats``: one anchor per
window, kept if its gram of eight words stands in two documents).  They are
then split by prefixes of *variable length*: prefixes of 1 to 8 words are
counted on a sample, and a suffix belongs to its shortest prefix that is no
longer heavy, so a group fits in memory and a common first word is cut
further by the words after it.  (A gram that is heavy as a whole is settled
inside the map tasks, which send one copy each.)  The sample sets balance
only, never results.

Each group grows its subtrees from the top: a node's suffixes branch by the
next words of the edge, a node whose suffixes lie in one document is not
expanded, and every node that is reached at a depth of ``length`` words is an
internal node whose leaves repeat across documents.  The leaves outside its
smallest document are removed; neighbouring leaves together are the maximal
repeats, returned as word spans.

Defined results: null, empty and blank texts have no words; a null id orders
after all others; rows that share an id never remove each other's words; other
columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.arrays import (BASE, U64, column_bytes, group_edges, minimizers, mix, slices, word_bounds,
                                word_hashes)
from kpiloom.llm.repeats import SAMPLE_ONE_IN, repeated_spans, row_spans, window_starts
from kpiloom.llm.tables import bucket_of, keyed, original_id, stored

LENGTH = 50
GRAM = 8                   # leading words that choose the anchor: the longest prefix
GROUP_SUFFIXES = 20_000    # anchors a prefix may hold before it is cut further, in a small table
SHARES = 8                 # in a large one: this part of the mean bucket


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two word sequences one after the other."""
    return mix(left * U64(BASE) ^ right)


def grams(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of the GRAM words from each position on."""
    h = words[at]
    for k in range(1, GRAM):
        h = joined(h, words[at + k])
    return h


class Words:
    """Text as word hashes; suffixes in trees partitioned by variable-length prefixes."""

    def __init__(self, length: int):
        self.length = length

    def anchors(self, data, offsets):
        words, before, _, _ = word_hashes(data, offsets)
        if len(words) < self.length:
            none = np.zeros(0, np.int64)
            return words, before, none.astype(U64), none, none, none, none
        h = grams(words, np.arange(len(words) - GRAM + 1))
        anchor, first, last = minimizers((h >> U64(32)).astype(np.uint32), window_starts(before, self.length),
                                         self.length - GRAM + 1, self.length)
        return words, before, mix(h[anchor]), np.searchsorted(before, first, side="right") - 1, anchor, first, last

    @staticmethod
    def codes(body):
        return body

    @staticmethod
    def gram(body, at):
        return grams(body, at)

    def smallest_holder(self, body: np.ndarray, at: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """For each suffix (at) of ``body``: the smallest id among the leaves of its node
        at depth ``length``; the suffix's own where the tree needs no such node."""
        best, node = ids.copy(), np.zeros(len(at), np.int64)
        leaf, depth = np.arange(len(at)), 0
        while depth < self.length:
            edge = min(max(1, depth), self.length - depth)       # edges of 1, 1, 2, 4, ... words
            label = body[at[leaf] + depth]
            for k in range(1, edge):
                label = joined(label, body[at[leaf] + depth + k])
            order = np.lexsort((label, node[leaf]))
            leaf = leaf[order]
            child = group_edges(node[leaf], label[order])
            low, high = np.minimum.reduceat(ids[leaf], child), np.maximum.reduceat(ids[leaf], child)
            size = np.diff(np.append(child, len(leaf)))
            node[leaf] = np.repeat(np.arange(len(child)), size)
            inner = np.repeat(low != high, size)                 # one document only: no inner node below
            low, leaf, depth = np.repeat(low, size)[inner], leaf[inner], depth + edge
            if not len(leaf):
                return best
        best[leaf] = low
        return best

    @staticmethod
    def leads(body, at):
        """Hashes of the prefixes of 1 .. GRAM words."""
        out = [body[at]]
        for k in range(1, GRAM):
            out.append(joined(out[-1], body[at + k]))
        return np.stack(out, axis=1).view(np.int64) if len(at) else np.zeros((0, GRAM), np.int64)

    @staticmethod
    def plan(leads: DataFrame, n: int) -> list[np.ndarray]:
        """The heavy prefixes of each length: those with more than a SHARES-th part of a bucket's
        mean sample, so that there are fewer than SHARES * n of them a length whatever the data."""
        counts = stored(leads.select(F.posexplode("lead").alias("k", "prefix")).groupBy("k", "prefix").count())
        total = counts.where("k = 0").agg(F.sum("count").alias("rows")).first()["rows"] or 0
        limit = max(2, GROUP_SUFFIXES // SAMPLE_ONE_IN ** 2, total // (SHARES * n))
        heavy = counts.where(F.col("count") > limit).collect()
        return [np.unique(np.array([r.prefix for r in heavy if r.k == k], np.int64)) for k in range(GRAM)]

    def deal(self, plan, body, at, n):
        """Bucket of each suffix: by its shortest prefix that is not heavy."""
        prefixes = self.leads(body, at)
        key, open_ = prefixes[:, -1].copy(), np.ones(len(at), bool)
        for k in range(GRAM - 1):
            light = open_ & ~np.isin(prefixes[:, k], plan[k])
            key[light] = prefixes[light, k]
            open_ &= ~light
        return bucket_of(mix(key.view(U64)), n)


def kept_text(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray,
              kept: np.ndarray) -> list[bytes]:
    """Each document's kept words joined by one space."""
    n = len(data)
    edge = np.zeros(n + 2, np.int8)
    s, e = starts[kept], ends[kept]
    follows = np.ones(len(s), bool)                 # whether the byte after a word is its own document's
    doc_end = offsets[1:][np.searchsorted(offsets, s, side="right") - 1]
    follows &= e < doc_end
    edge[s] += 1
    edge[e + follows] -= 1
    use = np.cumsum(edge[:n]) > 0
    out = data.copy()
    out[e[follows]] = 0x20
    at = np.concatenate([[0], np.cumsum(use)])[offsets]
    raw = out[use].tobytes()
    return [raw[a:b].rstrip(b" ") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def substring_dedup(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    length: int = LENGTH) -> DataFrame:
    """(id, n_words, spans, kept): removed word spans and the kept words of every row."""
    if not 2 * GRAM <= length <= 120:
        raise ValueError(f"length must be {2 * GRAM} to 120 words")
    docs = keyed(df, id_col, text_col)
    spans = repeated_spans(docs, Words(length))
    both = docs.join(spans, "id", "left").select(original_id(df, id_col), "text", "variant", "spans")

    def cut(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            runs = [*row_spans(batch, 2, 3)]
            n_words, kept = [], []
            for i, j in slices(offsets):
                text, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                starts, ends, before = word_bounds(text, off)
                keep = np.ones(len(starts), bool)
                for k in range(i, j):
                    for a, b in zip(*runs[k]):
                        keep[before[k - i] + a:before[k - i] + b] = False
                n_words.append(np.diff(before))
                kept += kept_text(text, off, starts, ends, before, keep)
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate([r[x] for r in runs])) for x in (0, 1)],
                                              names=["start", "end"])
            cuts = np.concatenate([[0], np.cumsum([len(r[0]) for r in runs])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate(n_words)), pa.ListArray.from_arrays(pa.array(cuts), flat),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=[id_col, "n_words", "spans", "kept"])

    kind = df.schema[id_col].dataType.simpleString()
    return both.mapInArrow(cut, f"{id_col} {kind}, n_words long, spans array<struct<start:long,end:long>>, kept string")
