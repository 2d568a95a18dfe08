"""Operator 1 against a brute force over all 50-byte strings."""

import hashlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import repeats as R
from kpiloom.llm import suffix_dedup as S
from kpiloom.llm.queries import QUERIES
from tests.llm.conftest import make_docs, repeated_texts


def brute(rows, length=50):
    first = {}
    key = lambda d: float("inf") if d is None else d
    for d, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            first[s] = min(first.get(s, float("inf")), key(d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < key(d):
                gone[p:p + length] = True
        n_spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(np.frombuffer(b, np.uint8)[~gone[:-1]])
        out.append((d, len(b), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def query_rows(spark, tmp_path, rows, name="op1_suffix_array_dedup"):
    make_docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    return Counter(tuple(r)[:5] for r in QUERIES[name](spark, str(tmp_path)).collect())


def test_query_equals_brute_force(spark, tmp_path, repeats):
    assert query_rows(spark, tmp_path, repeats) == brute(repeats)


def test_hot_passage_over_many_tasks(spark, tmp_path):
    rows = repeated_texts(seed=3, n=30)
    passage = " ".join(f"word{i}" for i in range(30))
    rows += [(1000 + i, f"a{i} {passage} z{i}") for i in range(200)]
    docs = make_docs(spark, rows).repartition(16)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = Counter(tuple(r)[:5] for r in QUERIES["op1_suffix_array_dedup"](spark, str(tmp_path)).collect())
    assert got == brute(rows)


def test_empty_table_and_extra_columns(spark, tmp_path):
    assert S.suffix_dedup(make_docs(spark, [])).count() == 0
    df = spark.createDataFrame([(1, "q" * 60, "id", 3), (2, "q" * 55, "text", 4)],
                               "doc_id int, text string, id string, spans int")
    got = {r.doc_id: (r.n_bytes, [tuple(x) for x in r.spans], bytes(r.kept)) for r in S.suffix_dedup(df).collect()}
    assert got == {1: (60, [], b"q" * 60), 2: (55, [(0, 55)], b"")}


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("ab", max_size=160), min_size=1, max_size=6), st.randoms())
def test_blocks_settle_like_brute_force(texts, rnd):
    """The in-task comparison alone, over all anchors, on periodic texts."""
    length = 50
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    kind = S.Bytes(length)
    _, _, _, doc, anchor, first, last = kind.anchors(data, off)
    assert int((last - first + 1).sum()) == sum(max(0, len(x) - length + 1) for x in raw)
    if not len(doc):
        return
    body, begin = R.gather(data, first, last - first + length)
    block, s, e, _ = R.settle(kind, body, begin, anchor - first, last - first + 1, doc)
    gone = np.zeros(len(data), bool)
    for b, x, y in zip(block, first[block] + s, first[block] + e):
        gone[x:y] = True
    want = brute(list(enumerate(texts)))
    got = Counter((i, len(raw[i]), int(gone[off[i]:off[i + 1]].sum())) for i in range(len(raw)))
    assert got == Counter(k[:3] for k in want.elements())
