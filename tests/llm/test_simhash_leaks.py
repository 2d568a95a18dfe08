"""Operator 4 against a brute force over all item-sized windows."""

import random
import re
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import simhash_leaks as S
from kpiloom.llm.queries import QUERIES
from tests.conftest import SF_CHECK
from tests.llm.conftest import make_docs

SPLIT = re.compile(r"[ \t\n\x0b\f\r]+")


def words(t):
    return [w for w in SPLIT.split((t or "").lower()) if w]


def grams(w, k):
    return [tuple(w[i:i + k]) for i in range(len(w) - k + 1)]


def brute(docs, items, k=5, least=0.8):
    """Best similarity of every pair that reaches the threshold."""
    out = {}
    for item, t in items:
        iw = words(t)
        if not iw:
            continue
        kk = min(k, len(iw))
        a = Counter(grams(iw, kk))
        for d, text in docs:
            w = words(text)
            near = [i for i, g in enumerate(grams(w, kk)) if g in a]
            if len(near) < least * len(iw) / 2 - k:
                continue
            for s in range(max(0, len(w) - len(iw)) + 1):
                if not any(s <= i < s + len(iw) for i in near):
                    continue
                b = Counter(grams(w[s:s + len(iw)], kk))
                both = sum((a & b).values())
                j = both / max(1, sum(a.values()) + sum(b.values()) - both)
                if j >= least:
                    out[d, item] = max(out.get((d, item), 0), j)
    return out


def got(df):
    return {(r.doc_id, r.item_id): round(r.similarity, 9) for r in df.collect()}


def make_items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def rounded(x):
    return {k: round(v, 9) for k, v in x.items()}


def leaky(seed=2):
    rnd = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(14, 60)))) for i in range(25)]
    items += [(90, "two words"), (91, "la la la la la la la la la la la la"), (92, ""), (93, None), (94, "One")]
    docs = []
    for d in range(120):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randrange(0, 200))]
        if d % 2:
            leak = words(rnd.choice(items[:25])[1])
            for _ in range(rnd.randrange(0, 3)):
                at = rnd.randrange(len(leak))
                leak[at:at + rnd.randrange(0, 2)] = [rnd.choice(vocabulary)] * rnd.randrange(0, 2)
            a = rnd.randrange(len(w) + 1)
            w[a:a] = leak
        docs.append((d, rnd.choice([" ", "\n", " \t"]).join(w).upper() if d % 5 == 0 else " ".join(w)))
    docs += [(500, "La " * 30), (501, "some two words"), (502, None), (503, ""), (504, "two"), (505, items[0][1]),
             (506, " ".join(words(items[1][1])[:-1])), (505, items[0][1])]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = leaky()
    want = brute(docs, items)
    assert len(want) > 40
    assert got(S.leaks(make_docs(spark, docs), make_items(spark, items))) == rounded(want)


def test_reordered_items(spark):
    """Parts of an item in another order: halves, thirds and the last words first; alone, at the ends and inside."""
    rnd = random.Random(11)
    some = lambda n: [f"v{rnd.randrange(5000)}" for _ in range(n)]
    items = [(i, " ".join(some(100 + 7 * i))) for i in range(8)]
    docs = []
    for i, t in items:
        w = words(t)
        n = len(w)
        for order in (w[n // 2:] + w[:n // 2], w[-20:] + w[:-20], w[2 * n // 3:] + w[n // 3:2 * n // 3] + w[:n // 3]):
            for before, after in ((0, 0), (300, 300), (0, 90), (90, 0)):
                docs.append((len(docs), " ".join(some(before) + order + some(after))))
    want = brute(docs, items)
    assert len(want) >= 64
    assert got(S.leaks(make_docs(spark, docs), make_items(spark, items))) == rounded(want)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(S, "BROADCAST_ROWS", 0)
    docs, items = leaky(seed=3)
    assert got(S.leaks(make_docs(spark, docs), make_items(spark, items))) == rounded(brute(docs, items))


def test_whole_table_equals_brute_force(spark):
    read = lambda t, c: list(zip(*(pq.read_table(f"{SF_CHECK}/{t}.parquet")[x].to_pylist() for x in c)))
    want = brute(read("documents", ("doc_id", "text")), read("benchmark", ("item_id", "text")))
    assert want
    df = QUERIES["op4_benchmark_decontamination"](spark, SF_CHECK)
    assert got(df) == rounded(want)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_sides_and_extra_columns(spark):
    docs, items = make_docs(spark, [(1, "a b c d e f g")]), make_items(spark, [(1, "a b c d e f g")])
    assert got(S.leaks(docs.withColumn("item", F.lit(3)).withColumn("codes", F.lit("x")), items)) == {(1, 1): 1.0}
    assert S.leaks(docs.limit(0), items).count() == 0
    assert S.leaks(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 7, 64, 255, 400])
def test_simhash_counts_bits(spark, n):
    rnd = random.Random(n)
    codes = [rnd.randrange(-2**63, 2**63) for _ in range(n)]
    want = sum((sum(c >> b & 1 for c in codes) * 2 > n) << b for b in range(64))
    df = spark.createDataFrame([(codes,)], "codes array<long>")
    assert df.select(S.simhash(F.col("codes"))).first()[0] % 2**64 == want


def test_counters_of_very_long_items(spark):
    """Both widths of counters agree; beyond 2**18 hashes the fingerprint is still the majority of each bit."""
    some = spark.range(40).select(F.transform(F.sequence(F.lit(0), F.col("id")), lambda i: F.xxhash64(i, "id")).alias("c"))
    assert some.where(S.majority(F.col("c"), S.NARROW) != S.majority(F.col("c"), S.WIDE)).count() == 0
    n = (1 << 18) + 5
    long = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.when(
        i <= n * 3 // 4, F.lit(-6148914691236517206)).otherwise(F.xxhash64(i))).alias("c"))
    assert long.select(S.simhash(F.col("c"))).first()[0] == -6148914691236517206
