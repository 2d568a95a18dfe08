"""Operator 7: toxicity by weak supervision.

1. Patterns: whole words (ASCII punctuation stripped, A-Z lower-cased) and
   word beginnings of 3 to 8 bytes, counted by document on at most
   ``sample`` labelled rows outside the held-out fold; those far more common
   in toxic documents become the lexicon (at most PATTERNS of them).
2. Voters: the lexicon is dealt to voters by kind of pattern and strength, each
   voting toxic where it has a hit; counting voters vote on several hits and
   on their density; silence voters vote clean.  Others abstain.
3. Label model: a generative model of the votes, fitted by EM without labels.
   Each voter has its own rates of toxic, clean and no vote under either class
   (its accuracy); correlations of the votes within the classes are estimated
   too, and a voter's evidence is divided by the total correlation it shares.
4. A logistic regression on per-pattern-kind counts and densities is trained
   on the label model's posteriors and scores every whole text.

All models are fitted on the driver from the bounded sample (``sample`` rows
of a few dozen numbers); scoring is one scan without a shuffle.  Labels are read
only from rows outside the held-out fold; language, source and id are no inputs.

Defined results: null, empty and blank texts are scored like a text without
hits; a null label or a null id trains nothing; a repeated label row counts
once (the larger label); without toxic and clean training rows every score
is 0; other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.arrays import BASE, LOWER_CODE, U64, _powers, column_bytes, mix, slices, word_bounds
from kpiloom.llm.quality import fold
from kpiloom.llm.tables import stored

SAMPLE = 40_000            # labelled rows used for fitting (documented bound)
PIECE = 2 << 20            # bytes of text a task has in work at once: about 60 MB of hashes and cells
PATTERNS = 4_000           # lexicon size at most
LENGTHS = (3, 4, 5, 6, 7, 8)          # bytes of word beginnings
KINDS = len(LENGTHS) + 1
STRONG = 3                 # strength classes of a kind
EDGE = np.zeros(256, bool)
EDGE[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def pattern_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, words before each document): a row per word; first the word's hash, then those of its
    beginnings (0 where the word is shorter)."""
    starts, ends, before = word_bounds(data, offsets)
    inner = np.flatnonzero(~EDGE[data])    # strip the whole run of signs on either side; a word of signs keeps its last
    after = np.append(inner, len(data))[np.searchsorted(inner, starts)]
    starts = np.minimum(after, ends - 1)
    last = np.append(inner, -1)[np.searchsorted(inner, ends) - 1]
    ends = np.maximum(last, starts) + 1
    out = np.zeros((len(starts), KINDS), U64)
    if len(starts):
        i = 0
        while i < len(starts):             # a slice's worth of bytes at a time
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + (4 << 20), side="right")))
            a = starts[i]
            codes = LOWER_CODE[data[a:ends[i:j].max()]]
            up, down = _powers(len(codes) + 1)
            total = np.concatenate([np.zeros(1, U64), np.cumsum(codes * up[:len(codes)])])
            s, e = starts[i:j] - a, ends[i:j] - a
            base = total[s]
            out[i:j, 0] = mix((total[e] - base) * down[s] ^ U64(0xA5A5))
            for k, size in enumerate(LENGTHS, 1):
                long = e - s >= size
                h = mix((total[np.minimum(s + size, e)] - base) * down[s] ^ U64(size))
                out[i:j, k] = np.where(long, h, U64(0))
            i = j
    return out, before


class Lexicon:
    """Learned patterns: sorted hashes with the kind and strength class of each."""

    def __init__(self, hashes: np.ndarray, kinds: np.ndarray, strengths: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.cell = hashes[order], (kinds * STRONG + strengths)[order]
        self.sieve = np.zeros(1 << 18, bool)
        self.sieve[(self.hashes >> U64(46)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Hits of every document in each (kind, strength) cell, and its words, as counts."""
        n = len(before) - 1
        out = np.zeros((n, KINDS * STRONG + 1))
        out[:, -1] = np.diff(before)
        owner = np.repeat(np.arange(n), np.diff(before))
        for k in range(KINDS if len(self.hashes) else 0):
            h = hashes[:, k]
            near = np.flatnonzero(self.sieve[(h >> U64(46)).astype(np.int64)] & (h != 0))
            at = np.minimum(np.searchsorted(self.hashes, h[near]), len(self.hashes) - 1)
            real = self.hashes[at] == h[near]
            np.add.at(out, (owner[near[real]], self.cell[at[real]]), 1)
        return out


def votes(hits: np.ndarray) -> np.ndarray:
    """Votes of every voter on every document: 1 toxic, -1 clean, 0 abstains."""
    cells, words = hits[:, :-1], np.maximum(hits[:, -1:], 1)
    kinds = cells.reshape(len(hits), KINDS, STRONG)
    per_kind, per_strength = kinds.sum(axis=2), kinds.sum(axis=1)
    found = np.concatenate([(kinds > 0).reshape(len(hits), -1), per_kind >= 2, per_strength >= 3,
                            per_kind / words > 0.01], axis=1).astype(np.int8)
    silent = -np.concatenate([per_kind == 0, per_strength == 0], axis=1).astype(np.int8)
    return np.concatenate([found, silent], axis=1)


def label_model(v: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior probability of toxic for each row of votes, by EM with correlation-shared evidence."""
    n, m = v.shape
    use = np.flatnonzero((v != v[:1]).any(axis=0)) if n else np.arange(0)
    if not len(use):
        return np.zeros(n)
    v = v[:, use]
    indicator = np.stack([v == 1, v == -1, v == 0], axis=2).astype(float)
    # start from the standardised votes, correlated voters sharing one voice
    z = (v - v.mean(axis=0)) / v.std(axis=0)
    z /= np.abs(z.T @ z / n).sum(axis=0)
    post = 1 / (1 + np.exp(-4 * z.sum(axis=1)))
    for _ in range(rounds):
        rate, shared = [], np.zeros((len(use), len(use)))
        for p in (1 - post, post):
            total = p.sum() + 2
            rate.append((np.einsum("n,nmk->mk", p, indicator) + 0.5) / (total + 0.5))
            mean = p @ v / p.sum()
            c = (v - mean).T @ ((v - mean) * p[:, None]) / p.sum()
            sd = np.sqrt(np.maximum(np.diag(c), 1e-9))
            shared += p.sum() / n * np.abs(c / np.outer(sd, sd))
        weight = 1 / np.maximum(shared.sum(axis=0), 1)
        evidence = np.einsum("nmk,mk->n", indicator, (np.log(rate[1]) - np.log(rate[0])) * weight[:, None])
        prior = np.clip(post.mean(), 1e-4, 1 - 1e-4)
        new = 1 / (1 + np.exp(np.clip(-evidence - np.log(prior / (1 - prior)), -500, 500)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return post


def inputs(hits: np.ndarray) -> np.ndarray:
    """Inputs of the linear classifier: logs of counts and densities by cell."""
    cells, words = hits[:, :-1], np.maximum(hits[:, -1:], 1)
    kinds = cells.reshape(len(hits), KINDS, STRONG)
    return np.concatenate([np.ones((len(hits), 1)), np.log1p(cells), np.log1p(kinds.sum(axis=2)),
                           np.sqrt(kinds.sum(axis=1) / words), (kinds.sum(axis=1) > 0)], axis=1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a ridge logistic regression on soft labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) + penalty * w
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-6)[:, None]) + np.diag(penalty), g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """The patterns of (label, text) rows that mark toxic documents."""
    def count(batches):
        for batch in batches:
            label = batch.column(0).to_numpy()
            data, offsets = column_bytes(batch.column(1))
            for i, j in slices(offsets):
                h, before = pattern_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                owner = np.repeat(np.arange(j - i), np.diff(before))
                for k in range(KINDS):
                    real = h[:, k] != 0
                    at = np.flatnonzero(real)
                    # one occurrence of each (pattern, document)
                    _, first = np.unique(mix(h[at, k] ^ owner[at].astype(U64) * U64(BASE)), return_index=True)
                    at = at[first]
                    value, where = np.unique(h[at, k], return_inverse=True)
                    toxic = np.bincount(where, weights=label[i:j][owner[at]], minlength=len(value))
                    every = np.bincount(where, minlength=len(value))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(value.view(np.int64)), pa.array(np.full(len(value), k, np.int32)),
                         pa.array(toxic.astype(np.int64)), pa.array(every.astype(np.int64) - toxic.astype(np.int64))],
                        names=["pattern", "kind", "toxic", "clean"])

    n = rows.agg(F.sum("label").alias("t"), F.count("*").alias("n")).first()
    toxic, clean = float(n.t or 0), float(n.n - (n.t or 0))
    none = Lexicon(np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    if not toxic or not clean:
        return none
    counted = rows.mapInArrow(count, "pattern long, kind int, toxic long, clean long") \
        .groupBy("pattern", "kind").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    lift = (F.col("t") + 0.5) / (toxic + 1) / ((F.col("c") + 0.5) / (clean + 1))
    least = max(3.0, toxic / 1000)
    best = counted.where((F.col("t") >= least) & (lift >= 8)).withColumn("lift", lift) \
        .orderBy((F.col("t") * F.log("lift")).desc(), "pattern").limit(PATTERNS).collect()
    if not best:
        return none
    strength = np.digitize([r.lift for r in best], [25.0, 100.0])
    return Lexicon(np.array([r.pattern for r in best], np.int64).view(U64), np.array([r.kind for r in best]), strength)


class Model:
    """A fitted lexicon and the weights of the linear classifier (None: nothing to learn from)."""

    def __init__(self, lexicon: Lexicon, weights: np.ndarray | None):
        self.lexicon, self.weights = lexicon, weights

    def scores(self, column: pa.Array) -> np.ndarray:
        """Probability of toxic of every text of an Arrow column."""
        data, offsets = column_bytes(column)
        out = np.zeros(len(column))
        for i, j in slices(offsets, PIECE) if self.weights is not None else ():
            hits = self.lexicon.hits(*pattern_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
            out[i:j] = 1 / (1 + np.exp(-np.clip(inputs(hits) @ self.weights, -500, 500)))
        return out


def fit(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        parts: int = 5, held: int = 0, sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` labelled rows whose fold is not ``held``."""
    docs = df.select(df[id_col], df[text_col].cast("string").alias("text"))
    chosen = stored(labels.where(F.col(label_col).isNotNull() & (fold(F.col(id_col), parts) != held))
                    .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
                    .orderBy(F.xxhash64("_id"), "_id").limit(sample))
    # at most ``sample`` rows of two numbers: broadcast, so the texts stay where they are
    known = stored(docs.join(F.broadcast(chosen), docs[id_col] == chosen["_id"])
                   .select(F.col("label").cast("long").alias("label"), "text"))
    lexicon = learn_lexicon(known)
    if not len(lexicon.hashes):
        return Model(lexicon, None)

    def count(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(0))
            for i, j in slices(offsets, PIECE):
                h = lexicon.hits(*pattern_hashes(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
                cuts = pa.array(np.arange(len(h) + 1, dtype=np.int32) * h.shape[1])
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(cuts, pa.array(h.reshape(-1)))],
                                                 names=["hits"])

    rows = known.select("text").mapInArrow(count, "hits array<double>").limit(sample).collect()
    hits = np.array([r.hits for r in rows])
    return Model(lexicon, logistic(inputs(hits), label_model(votes(hits))))


def toxicity_scores(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", parts: int = 5, held: int = 0, sample: int = SAMPLE) -> DataFrame:
    """(id, held_out, score, predicted) of every row; learns from labels whose fold is not ``held``."""
    model = fit(df, labels, id_col=id_col, text_col=text_col, label_col=label_col, parts=parts, held=held,
                sample=sample)

    def run(batches):
        for batch in batches:
            s = model.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(s),
                                              pa.array((s >= 0.5).astype(np.int32))],
                                             names=[id_col, "held_out", "score", "predicted"])

    out = F.coalesce(fold(F.col(id_col), parts) == held, F.lit(False)).alias("held_out")
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(df[id_col], df[text_col].cast("string").alias("text"), out) \
        .mapInArrow(run, f"{id_col} {kind}, held_out boolean, score double, predicted int")


def without_toxic(df: DataFrame, labels: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that are not predicted toxic, all columns unchanged."""
    model = fit(df, labels, text_col=text_col, **options)
    at = df.columns.index(text_col)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at)) < 0.5))

    return df.mapInArrow(run, df.schema)
