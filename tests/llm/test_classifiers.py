"""Operators 6 and 7: held-out accuracy, folds, and odd inputs."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import quality as Q
from kpiloom.llm import toxicity as T
from kpiloom.llm.queries import QUERIES
from tests.llm.conftest import make_docs

SF = "/root/testdata/sf0.1"


def held_out(spark, name, label):
    df = QUERIES[name](spark, SF)
    assert df.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    rows = df.join(labels, "doc_id").where("held_out").collect()
    y, p = np.array([r.y for r in rows]), np.array([r.predicted for r in rows])
    return (p[y == 1] == 1).mean(), (p[y == 0] == 0).mean()


def test_quality_held_out(spark):
    recall, specificity = held_out(spark, "op6_quality_classifier", "quality")
    assert recall > 0.98 and specificity > 0.97


def test_toxicity_held_out(spark):
    recall, specificity = held_out(spark, "op7_toxicity", "toxic")
    assert recall > 0.85 and specificity > 0.99


@pytest.mark.parametrize("score", [lambda d, lab: Q.quality_scores(d, lab), lambda d, lab: T.toxicity_scores(d, lab)])
def test_folds_odd_rows_and_missing_labels(spark, score):
    rows = [(1, "good words here"), (2, None), (3, ""), (None, "some text"), (5, " \n "), (5, " \n "), (6, "x" * 30000)]
    labels = spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    got = score(make_docs(spark, rows), labels).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    parts = 3 if got[0].score == 0.5 else 5
    held = 1 if parts == 3 else 0
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % parts == held) for r in got)
    assert score(make_docs(spark, []), labels).count() == 0


def test_labels_of_the_held_out_fold_are_never_read(spark):
    docs = make_docs(spark, [(i, f"word{i % 7} nasty" if i % 2 else f"word{i % 7} calm text here") for i in range(300)])
    lab = [(i, i % 2, i % 2) for i in range(300)]
    flip = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q,
             1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in lab]
    ddl = "doc_id long, quality int, toxic int"
    for f in (Q.quality_scores, T.toxicity_scores):
        a, b = (sorted(map(tuple, f(docs, spark.createDataFrame(x, ddl)).collect())) for x in (lab, flip))
        assert [x[:2] + x[3:] for x in a] == [x[:2] + x[3:] for x in b]
        assert np.allclose([x[2] for x in a], [x[2] for x in b])


def test_label_model_finds_accuracies_of_correlated_voters():
    rnd = np.random.default_rng(0)
    y = rnd.random(4000) < 0.2
    good = [np.where(rnd.random(4000) < a, y, ~y) for a in (0.95, 0.9, 0.9, 0.85)]
    copied = np.where(rnd.random(4000) < 0.7, y, ~y)
    v = np.stack([np.where(x, 1, -1) for x in [*good, copied, copied]], axis=1).astype(np.int8)
    post = T.label_model(v)
    assert ((post > 0.5) == y).mean() > 0.93


def test_discriminant_matches_closed_form():
    rnd = np.random.default_rng(1)
    x = np.concatenate([rnd.normal(0, 1, (500, 3)), rnd.normal(2, 2, (500, 3))])
    y = np.repeat([0, 1], 500)
    m = {k: (500.0, x[y == k].sum(axis=0), x[y == k].T @ x[y == k]) for k in (0, 1)}
    s = Q.scores(x, Q.fit(m, 0.0, 0.0))
    def log_density(k):
        c, mu = np.cov(x[y == k].T, bias=True), x[y == k].mean(axis=0)
        z = x - mu
        return -0.5 * np.einsum("ni,ij,nj->n", z, np.linalg.inv(c), z) - 0.5 * np.log(np.linalg.det(c))
    assert np.allclose(s, 1 / (1 + np.exp(log_density(0) - log_density(1))), atol=1e-6)


@pytest.mark.parametrize("signs", ["!", "*" * 9, "#" * 500, "(\"'"])
def test_signs_around_a_word_change_nothing(signs):
    def first(text):
        raw = text.encode()
        return T.pattern_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0][0]
    assert (first(f"{signs}Word{signs} x") == first("word")).all()
    assert (first(f"{signs}a-b{signs}") == first("a-b")).all()
    assert T.pattern_hashes(np.frombuffer(signs.encode(), np.uint8), np.array([0, len(signs)]))[0].shape[0] == 1


def test_toxicity_scores_a_batch_in_pieces(monkeypatch):
    """The pipeline's toxicity stage: a large Arrow batch never has all its hashes in memory at once."""
    import numpy as np
    import pyarrow as pa
    from kpiloom.llm import toxicity as t
    texts = pa.array([f"bad word {k} " * 2000 for k in range(300)], pa.large_string())
    hashes = np.unique(t.pattern_hashes(*t.column_bytes(texts[:2]))[0])
    hashes = hashes[hashes != 0]
    lexicon = t.Lexicon(hashes, np.arange(len(hashes)) % t.KINDS, np.arange(len(hashes)) % t.STRONG)
    model = t.Model(lexicon, np.linspace(-.1, .1, t.inputs(np.zeros((1, t.KINDS * t.STRONG + 1))).shape[1]))
    sizes, real = [], t.pattern_hashes
    monkeypatch.setattr(t, "pattern_hashes", lambda data, offsets: (sizes.append(len(data)), real(data, offsets))[1])
    got = model.scores(texts)
    assert max(sizes) <= t.PIECE < sum(sizes)
    monkeypatch.setattr(t, "PIECE", 1 << 30)
    assert np.allclose(got, model.scores(texts), rtol=0, atol=1e-12)
