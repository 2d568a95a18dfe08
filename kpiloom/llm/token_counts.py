"""Operator 10: token counts by a compiled finite-state tokenizer.

A byte-level BPE vocabulary (tokenizers ``.json``) is compiled into two
deterministic transducers:

* the splitter, a 14-state machine over eleven character classes whose
  transitions say where a piece begins (before the current or, one step late,
  before the previous character, which replaces the pattern's lookahead);
* the lexicon, which gives every piece the number of tokens it emits (its
  merges are applied once per distinct piece and kept in a bounded cache).

A task cuts its text into chunks of equal length, runs every chunk from every
state at once (a state map per chunk), composes the maps by a parallel prefix
scan to learn each chunk's true entry state, and replays the chunks from
those.  The emitted counts are summed by a running scan whose differences at
document ends are the counts.  There is no shuffle: one scan, one row each.

Special strings of the vocabulary (``<|endoftext|>``) found inside a text are
one token each and end the piece before them, as the library's default does.
Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows
each get their row; other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import heapq
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from kpiloom.llm.arrays import (BASE, SLICE_BYTES, U64, column_bytes, group_edges, mix, slices, span_hashes,
                                worker_cache)

CHUNK = 256                # characters per chunk of the prefix scan
SETTLE = 8                 # characters after which nearly every chunk's state is known
CACHE_PIECES = 400_000     # distinct pieces kept per worker; only speed depends on it
LONG_PIECE = 48            # longer pieces merge by a heap instead of in rounds
STOP, SPECIAL = 0x110000, 0x110001    # code points past Unicode: document end, special token

# Character classes: space, other white space, apostrophe, number, other,
# letters by the part they play in 's 't 'm 'd 're 've 'll, end of text.
CLASSES = ["SP", "WS", "AP", "N", "O", "LS", "LR", "LV", "LL", "LE", "LX", "END"]
LETTERS = ["LS", "LR", "LV", "LL", "LE", "LX"]
# States: 0 at a border; in letters, numbers, others; after a finished
# contraction; one white space or several, the last a space or not; after an
# apostrophe that begins a piece; after that apostrophe and r, v or l.
STATES = ["0", "L", "N", "O", "C", "1s", "1o", "ms", "mo", "A", "AR", "AV", "AL"]
HERE, BEFORE = 1, 2        # a piece begins at this character / at the one before


def _fresh(c: str) -> str:
    return {"SP": "1s", "WS": "1o", "AP": "A", "N": "N", "O": "O", "END": "0"}.get(c, "L")


def _step(state: str, c: str) -> tuple[str, int]:
    """One transition: (next state, where pieces begin)."""
    late = 0
    if state in ("AR", "AV", "AL"):
        if c == ("LL" if state == "AL" else "LE"):
            return "C", 0
        state, late = "L", BEFORE              # the letter was no contraction: it begins a word
    if c == "END":
        return "0", late
    if state == "A":
        if c == "LS":
            return "C", 0
        if c in ("LR", "LV", "LL"):
            return "A" + c[1], 0
        if c in ("AP", "O"):
            return "O", 0
    if (state == "L" and c in LETTERS) or (state == "N" and c == "N") or (state == "O" and c in ("O", "AP")):
        return state, late
    if state in ("1s", "1o", "ms", "mo"):
        if c in ("SP", "WS"):
            return "ms" if c == "SP" else "mo", 0
        if state in ("1s", "ms"):              # the last space joins what follows
            joined = "L" if c in LETTERS else "N" if c == "N" else "O"
            return joined, BEFORE if state == "ms" else 0
        return _fresh(c), HERE | (BEFORE if state == "mo" else 0)
    return _fresh(c), HERE | late


@functools.lru_cache(1)
def splitter() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(next state, output) tables by state * classes + class, and the class of every code point."""
    k = len(CLASSES)
    nxt, out = np.zeros(len(STATES) * k, np.uint8), np.zeros(len(STATES) * k, np.uint8)
    for i, s in enumerate(STATES):
        for j, c in enumerate(CLASSES):
            to, o = _step(s, c)
            nxt[i * k + j], out[i * k + j] = STATES.index(to), o
    points = [p for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    every = "".join(map(chr, points))
    cls = np.full(SPECIAL + 1, CLASSES.index("O"), np.uint8)
    at = np.array(points)
    for name, pattern in (("LX", r"\p{L}"), ("N", r"\p{N}"), ("WS", r"\s")):
        hits = [m.span() for m in regex.finditer(pattern + "+", every)]
        for a, b in hits:
            cls[at[a:b]] = CLASSES.index(name)
    for name, chars in (("SP", " "), ("AP", "'"), ("LS", "stmd"), ("LR", "r"), ("LV", "v"), ("LL", "l"), ("LE", "e")):
        for ch in chars:
            cls[ord(ch)] = CLASSES.index(name)
    cls[[STOP, SPECIAL]] = CLASSES.index("END")
    return nxt, out, cls


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    bytes for themselves, the others for 256, 257, ... in order."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return [chr(b) if b in keep else chr(256 + sorted(set(range(256)) - set(keep)).index(b)) for b in range(256)]


class PairTable:
    """The merges as arrays: pair of tokens -> rank, by hashing into a few tables
    of falling size (what collides in one goes on to the next)."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, keys: np.ndarray):
        self.keys, self.levels = np.append(keys, np.int64(-1)), []
        rest, bits = np.arange(len(keys)), 18
        while len(rest):
            factor = U64(BASE + 2 * len(self.levels) * 0x1234567)
            slot = self._slot(keys[rest], factor, bits)
            table = np.full(1 << bits, len(keys), np.int32)
            table[slot[::-1]] = rest[::-1]
            self.levels.append((factor, bits, table))
            rest = rest[table[slot] != rest]

    @staticmethod
    def _slot(keys, factor, bits):
        return ((keys.astype(U64) * factor) >> U64(64 - bits)).astype(np.int64)

    def rank(self, keys: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(keys), self.NONE, np.int32), np.arange(len(keys))
        for factor, bits, table in self.levels:
            left = keys[open_]
            got = table[self._slot(left, factor, bits)]
            hit = self.keys[got] == left
            out[open_[hit]] = got[hit]
            open_ = open_[~hit]
        return out


class Lexicon:
    """Tokens of a piece under the vocabulary's merges."""

    def __init__(self, model_json: str):
        spec = json.loads(model_json)
        vocab = spec["model"]["vocab"]
        self.ids = np.array([vocab[x] for x in byte_letters()], np.int64)
        pairs = [x if isinstance(x, list) else x.split(" ") for x in spec["model"]["merges"]]
        left, right = (np.array([vocab[x[i]] for x in pairs], np.int64) for i in (0, 1))
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.table = PairTable(left << 20 | right)
        self.merges = {(a, b): (i, m) for i, (a, b, m) in
                       reversed([*enumerate(zip(left.tolist(), right.tolist(), self.made.tolist()))])}
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.cache = worker_cache(f"pieces {hash(model_json)}")

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each piece: every round merges the best pair of each piece at once."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = np.zeros(len(pieces), np.int64)
        for i in np.flatnonzero(sizes > LONG_PIECE):
            out[i] = self._count_long(self.ids[np.frombuffer(pieces[i], np.uint8)].tolist())
        short = np.flatnonzero((sizes > 0) & (sizes <= LONG_PIECE))
        ids = self.ids[np.frombuffer(b"".join(pieces[i] for i in short), np.uint8)]
        owner = np.repeat(short, sizes[short])
        while len(ids):
            begin = group_edges(owner)
            pair = np.full(len(ids), -2, np.int64)
            pair[:-1] = ids[:-1] << 20 | ids[1:]
            pair[begin[1:] - 1] = -2                     # a piece's last token has no partner
            pair[-1] = -2
            rank = self.table.rank(pair)
            best = np.minimum.reduceat(rank, begin)
            size = np.diff(np.append(begin, len(ids)))
            done = best == PairTable.NONE
            out[owner[begin[done]]] = size[done]
            take = (rank == np.repeat(best, size)) & (rank != PairTable.NONE)
            at = np.flatnonzero(take)
            run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]     # in a row such as aaa, pairs from the left
            ids[at] = self.made[rank[at]]
            keep = ~np.repeat(done, size)
            keep[at + 1] = False
            ids, owner = ids[keep], owner[keep]
        return out

    def _count_long(self, ids: list[int]) -> int:
        """The same merges from a heap over a linked list, n log n for any length."""
        n, left, get = len(ids), len(ids), self.merges.get
        after, prior = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(got[0], i, ids[i], ids[i + 1], got[1]) for i in range(n - 1) if (got := get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, made = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue                        # one side has been merged since
            ids[i], ids[j], after[i] = made, -1, after[j]
            left -= 1
            if after[i] >= 0:
                prior[after[i]] = i
            for x in (prior[i], i):
                if x >= 0 and after[x] >= 0 and (got := get((ids[x], ids[after[x]]))):
                    heapq.heappush(heap, (got[0], x, ids[x], ids[after[x]], got[1]))
        return left


def entry_states(classes: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """State at the start of each chunk (rows of ``classes``), by composing the
    chunks' state maps in a parallel prefix scan."""
    k, s = len(CLASSES), len(STATES)
    wide = nxt.astype(np.int64) * k             # states as offsets into the table
    columns = classes.T.astype(np.int64)
    maps = np.repeat(np.arange(s)[:, None] * k, len(classes), axis=1)
    for j in range(SETTLE):
        maps = wide[maps + columns[j]]
    # most chunks have forgotten their entry state by now: go on with one state there
    vague = np.flatnonzero((maps != maps[0]).any(axis=0))
    one, some, rest = maps[0], maps[:, vague], columns[:, vague]
    for j in range(SETTLE, CHUNK):
        one = wide[one + columns[j]]
        some = wide[some + rest[j]]
    maps = np.repeat(one[None], s, axis=0)
    maps[:, vague] = some
    maps //= k
    step = 1
    while step < maps.shape[1]:                 # map[i] becomes map[i] after map[i - step]
        maps[:, step:] = np.take_along_axis(maps[:, step:], maps[:, :-step], axis=0)
        step *= 2
    return np.concatenate([[0], maps[0, :-1]])


def piece_bounds(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every piece of a run of code points that ends in STOP."""
    nxt, out, cls = splitter()
    k, n = len(CLASSES), len(points)
    m = -(-n // CHUNK)
    classes = np.full(m * CHUNK, k - 1, np.uint8)
    classes[:n] = cls[points]
    classes = classes.reshape(m, CHUNK)
    state = entry_states(classes, nxt)
    columns = np.ascontiguousarray(classes.T)
    flags = np.empty((CHUNK, m), np.uint8)
    wide, at = nxt.astype(np.int64) * k, state * k
    for j in range(CHUNK):
        at += columns[j]
        flags[j] = out[at]
        at = wide[at]
    flags = flags.T.reshape(-1)[:n]
    begin = (flags & HERE).astype(bool)
    begin[:-1] |= (flags[1:] & BEFORE).astype(bool)
    events = np.flatnonzero(begin | (points >= STOP))
    ends = np.append(events[1:], n)
    real = begin[events]
    return events[real], ends[real]


def code_points(texts: list[str], specials: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, STOP after each, SPECIAL for each special string; and the texts' ends."""
    parts, ends, at = [], [], 0
    stop = np.array([STOP], np.uint32)
    split = regex.compile("|".join(map(regex.escape, specials))) if specials else None
    for t in texts:
        pieces = split.split(t) if split is not None and any(x in t for x in specials) else [t]
        for i, p in enumerate(pieces):
            if i:
                parts.append(np.array([SPECIAL], np.uint32))
                at += 1
            parts.append(np.frombuffer(p.encode("utf-32-le"), np.uint32))
            at += len(parts[-1])
        parts.append(stop)
        at += 1
        ends.append(at)
    return np.concatenate(parts), np.array(ends)


def count_texts(texts: list[str], lexicon: Lexicon) -> np.ndarray:
    """Tokens of each text."""
    points, ends = code_points(texts, lexicon.specials)
    begin, end = piece_bounds(points)
    emitted = (points == SPECIAL).astype(np.int64)
    if len(begin):
        key = span_hashes(mix(points.astype(U64) + U64(1)), begin, end)
        distinct, first, where = np.unique(key, return_index=True, return_inverse=True)
        cache = lexicon.cache
        if len(cache) > CACHE_PIECES:
            cache.clear()
        counts = np.fromiter((cache.get(h, -1) for h in distinct.tolist()), np.int64, len(distinct))
        new = np.flatnonzero(counts < 0)
        at = first[new]
        counts[new] = lexicon.counts([points[a:b].tobytes().decode("utf-32-le").encode()
                                      for a, b in zip(begin[at].tolist(), end[at].tolist())])
        cache.update(zip(distinct[new].tolist(), counts[new].tolist()))
        emitted[begin] += counts[where]
    total = np.concatenate([[0], np.cumsum(emitted)])
    return np.diff(total[ends], prepend=0)


def token_counts(df: DataFrame, model_json: str, *, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row.

    ``model_json`` is the vocabulary file's content; its size is that of the
    file (1.5 MB), whatever the table.
    """
    thin = df.select(df[id_col].cast("long").alias(id_col), df[text_col].cast("string").alias("_text"))

    def run(batches):
        lexicon = Lexicon(model_json)
        for batch in batches:
            column = batch.column(1)
            data, offsets = column_bytes(column)
            counts = np.zeros(len(column), np.int64)
            for i, j in slices(offsets, SLICE_BYTES):
                texts = [x or "" for x in column.slice(i, j - i).to_pylist()]
                counts[i:j] = count_texts(texts, lexicon)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(counts), pa.array(counts > limit)],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"])

    return thin.mapInArrow(run, f"{id_col} long, n_bytes long, n_tokens long, over_limit boolean")
