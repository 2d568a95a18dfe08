"""Operator 5 against a brute force over all 50-word windows."""

import hashlib
import re
from collections import Counter

from kpiloom.llm import substring_dedup as S
from tests.llm.conftest import make_docs, repeated_texts
from tests.llm.test_suffix_dedup import query_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, length=50):
    first, key = {}, lambda d: float("inf") if d is None else d
    words = [WORD.findall(t or "") for _, t in rows]
    for (d, _), w in zip(rows, words):
        for p in range(len(w) - length + 1):
            s = tuple(w[p:p + length])
            first[s] = min(first.get(s, float("inf")), key(d))
    out = []
    for (d, _), w in zip(rows, words):
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p:p + length])] < key(d):
                gone[p:p + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_query_equals_brute_force(spark, tmp_path, repeats):
    rows = [*repeats, (900, " ".join(["la"] * 130)), (901, "la\t" * 70), (902, "la " * 49), (903, " ".join("ab") * 9)]
    want = brute(rows)
    assert sum(k[2] > 0 for k in want) > 20
    assert query_rows(spark, tmp_path, rows, "op5_substring_dedup") == want


def test_common_first_words_and_hot_passage(spark, tmp_path):
    rows = repeated_texts(seed=5, n=30)
    passage = " ".join(f"word{i}" for i in range(60))
    rows += [(1000 + i, f"a{i} {passage} z{i}") for i in range(150)]
    assert query_rows(spark, tmp_path, rows, "op5_substring_dedup") == brute(rows)


def test_empty_table(spark):
    assert S.substring_dedup(make_docs(spark, [])).count() == 0


def test_heavy_prefixes_are_cut_further():
    import numpy as np
    kind = S.Words(50)
    body = np.arange(1, 200, dtype=np.uint64) % np.uint64(7) + np.uint64(1)
    at = np.arange(100)
    leads = kind.leads(body, at)
    plan = [np.unique(leads[:, 0]), *[np.zeros(0, np.int64)] * (S.GRAM - 1)]
    light, cut = kind.deal([np.zeros(0, np.int64)] * S.GRAM, body, at, 1000), kind.deal(plan, body, at, 1000)
    assert len(set(light)) <= 7 and (cut != light).any()
    same = leads[:, 1][:, None] == leads[:, 1][None, :]
    assert ((cut[:, None] == cut[None, :]) | ~same).all()


def test_list_of_heavy_prefixes_is_bounded_by_the_buckets(spark):
    """A hundred times the rows: the list stays below SHARES a bucket and length."""
    n = 3
    leads = spark.range(200_000).selectExpr("transform(sequence(0, 7), k -> if(id % 3 = 0, 1, id % 500) div (8 - k)) AS lead")
    plan = S.Words.plan(leads, n)
    assert len(plan) == S.GRAM and 0 < sum(map(len, plan)) < S.SHARES * n * S.GRAM
    assert all(len(p) < S.SHARES * n for p in plan)
    small = S.Words.plan(leads.limit(2000), n)
    assert all(len(p) < S.SHARES * n for p in small)
