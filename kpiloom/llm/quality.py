"""Operator 6: quality scores by a regularised quadratic discriminant.

Every text becomes a row of transformed statistics (logs of sizes, square
roots of shares, entropies).  Both classes are Gaussians whose covariances are
shrunk twice, towards the pooled covariance and towards its mean variance; the
score is the logistic of the difference of their log densities, computed from
Mahalanobis distances with Cholesky factors that are made once and sent with
the task.

Training reads the labelled rows outside the held-out fold (all of them): the
class sums and cross products are added up in Spark, so the driver receives a
fixed number of moments (two classes x 24 x 25 / 2 + 24 + 1).  Language,
source and id are no inputs.

Defined results: null text counts as the empty text and is scored; without
rows of both classes every score is 0.5; a null label trains nothing; a
null id is not held out; a repeated label row counts once (the larger label);
other columns are left out; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.arrays import LOWER_CODE, column_bytes, slices, word_hashes
from kpiloom.llm.tables import stored

TO_POOLED, TO_SPHERE = 0.15, 0.05      # the two shrinkage weights

# Byte classes whose shares are inputs.
BYTE_CLASSES = {
    "upper": range(0x41, 0x5B), "lower": range(0x61, 0x7B), "digit": range(0x30, 0x3A), "space": b" \t\v\f\r",
    "line": b"\n", "stop": b".,;:?", "call": b"!", "mark": b"#$%&*", "bar": b"|/\\<>[]{}=+_~^@`", "wide": range(0x80, 0x100),
}
FEATURES = [*BYTE_CLASSES, "log_bytes", "log_words", "entropy", "distinct", "top_word", "again", "word_len", "word_sd",
            "one_letter", "end_mark", "end_stop", "capital", "line_words", "long_word"]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of transformed statistics for each document of a slice."""
    n = len(offsets) - 1
    classes = np.zeros((256, len(BYTE_CLASSES)))
    for c, members in enumerate(BYTE_CLASSES.values()):
        classes[list(members), c] = 1
    counts = np.zeros((n, 256))
    words, before, starts, ends = word_hashes(data, offsets, LOWER_CODE)
    n_words = np.diff(before).astype(float)
    distinct, top = np.zeros(n), np.zeros(n)
    for i in range(n):
        counts[i] = np.bincount(data[offsets[i]:offsets[i + 1]], minlength=256)
        if n_words[i]:
            _, c = np.unique(words[before[i]:before[i + 1]], return_counts=True)
            distinct[i], top[i] = len(c), c.max()
    size = counts.sum(axis=1)
    one = np.maximum(size, 1)
    share = counts / one[:, None]
    entropy = -(share * np.log(np.where(share > 0, share, 1))).sum(axis=1)
    owner = np.repeat(np.arange(n), np.diff(before))
    length = (ends - starts).astype(float)
    last, first = (data[ends - 1], data[starts]) if len(ends) else (np.zeros(0, np.uint8),) * 2
    same = np.zeros(len(words))
    same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])

    def per_word(x):
        return np.bincount(owner, weights=x, minlength=n) / np.maximum(n_words, 1)

    mean = per_word(length)
    spread = np.sqrt(np.maximum(per_word(length ** 2) - mean ** 2, 0))
    lines = counts[:, 10] + 1
    return np.column_stack([
        np.sqrt(share @ classes), np.log1p(size), np.log1p(n_words), entropy,
        np.log1p(distinct) - np.log1p(n_words), np.sqrt(top / np.maximum(n_words, 1)), np.sqrt(per_word(same)),
        np.log1p(mean), np.log1p(spread), np.sqrt(per_word(length == 1)),
        np.sqrt(per_word(np.isin(last, np.frombuffer(b"#$%&*!|", np.uint8)))),
        np.sqrt(per_word(np.isin(last, np.frombuffer(b".,;:?", np.uint8)))),
        np.sqrt(per_word((first >= 65) & (first <= 90))), np.log1p(n_words / lines), np.sqrt(per_word(length > 20))])


def fold(id_col: Column, parts: int) -> Column:
    """crc32 of the id's text modulo ``parts``."""
    return F.crc32(id_col.cast("string").cast("binary")) % parts


def document_statistics(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, stats) of every row."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for i, j in slices(offsets):
                rows = statistics(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                flat = pa.array(rows.reshape(-1))
                cuts = pa.array(np.arange(j - i + 1, dtype=np.int32) * rows.shape[1])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i),
                                                  pa.ListArray.from_arrays(cuts, flat)], names=[id_col, "stats"])

    thin = df.select(df[id_col], df[text_col].cast("string").alias("text"))
    return stored(thin.mapInArrow(run, f"{id_col} {kind}, stats array<double>"))


def class_moments(rows: DataFrame, d: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Count, sum and cross products of (label, stats) rows for labels 0 and 1."""
    def add(batches):
        total = {0: np.zeros((d + 1, d + 1)), 1: np.zeros((d + 1, d + 1))}
        for batch in batches:
            label = batch.column(0).to_numpy()
            x = batch.column(1).flatten().to_numpy().reshape(-1, d)
            x = np.column_stack([np.ones(len(x)), x])
            for k in total:
                total[k] += x[label == k].T @ x[label == k]
        a, b = np.triu_indices(d + 1)
        for k, t in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), k, np.int32)), pa.array((a * (d + 1) + b)),
                                              pa.array(t[a, b])], names=["label", "cell", "value"])

    got = rows.mapInArrow(add, "label int, cell long, value double").groupBy("label", "cell") \
        .agg(F.sum("value").alias("value")).collect()
    out = {}
    for k in (0, 1):
        t = np.zeros((d + 1, d + 1))
        for r in got:
            if r.label == k:
                t[r.cell // (d + 1), r.cell % (d + 1)] = r.value
        t = np.triu(t) + np.triu(t, 1).T
        out[k] = t[0, 0], t[0, 1:], t[1:, 1:]
    return out


def fit(moments: dict, to_pooled: float = TO_POOLED, to_sphere: float = TO_SPHERE):
    """(scale, per class: mean, Cholesky factor of the shrunk covariance, log prior) or None."""
    if any(moments[k][0] < 2 for k in (0, 1)):
        return None
    n = {k: moments[k][0] for k in (0, 1)}
    mean = {k: moments[k][1] / n[k] for k in (0, 1)}
    cov = {k: moments[k][2] / n[k] - np.outer(mean[k], mean[k]) for k in (0, 1)}
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / (n[0] + n[1])
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    unit = pooled / np.outer(scale, scale)
    model = {}
    for k in (0, 1):
        c = (1 - to_pooled) * cov[k] / np.outer(scale, scale) + to_pooled * unit
        c = (1 - to_sphere) * c + to_sphere * max(np.trace(c) / len(c), 1e-6) * np.eye(len(c))
        model[k] = mean[k] / scale, np.linalg.cholesky(c), np.log(n[k] / (n[0] + n[1]))
    return scale, model


def scores(x: np.ndarray, fitted) -> np.ndarray:
    """Probability of label 1 of each row of statistics."""
    if fitted is None:
        return np.full(len(x), 0.5)
    scale, model = fitted
    density = {}
    for k, (mean, chol, prior) in model.items():
        z = np.linalg.solve(chol, (x / scale - mean).T)
        density[k] = prior - 0.5 * (z ** 2).sum(axis=0) - np.log(np.diag(chol)).sum()
    return 1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500)))


def quality_scores(df: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", parts: int = 3, held: int = 1) -> DataFrame:
    """(id, held_out, score, predicted) of every row; learns from labels whose fold is not ``held``."""
    stats = document_statistics(df, id_col, text_col)
    known = labels.where(F.col(label_col).isNotNull() & (fold(F.col(id_col), parts) != held)) \
        .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
    d = len(FEATURES)
    rows = stats.join(known, stats[id_col] == known["_id"]).select("label", "stats")
    fitted = fit(class_moments(rows, d))

    def run(batches):
        for batch in batches:
            s = scores(batch.column(2).flatten().to_numpy().reshape(-1, d), fitted)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s),
                                              pa.array((s >= 0.5).astype(np.int32))],
                                             names=[id_col, "held_out", "score", "predicted"])

    out = F.coalesce(fold(F.col(id_col), parts) == held, F.lit(False))
    kind = df.schema[id_col].dataType.simpleString()
    return stats.select(id_col, out.alias("held_out"), "stats") \
        .mapInArrow(run, f"{id_col} {kind}, held_out boolean, score double, predicted int")
