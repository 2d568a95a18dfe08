"""Operators 3 and 9: laws of their contracts, against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

import pytest

from kpiloom.llm.kd_shards import kd_shards
from kpiloom.llm.pareto_mix import mixed_documents, pareto_mix
from kpiloom.llm.queries import QUERIES
from tests.conftest import SF_CHECK
from tests.llm.conftest import make_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shares(sizes, weights=(1, 2, 3), most=3):
    """Targets by the plain rule: share, cap, reshare the excess."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: most * sizes[s] for s in over})


def check_mix(rows, docs):
    text = Counter((d, None if t is None else len(WORD.findall(t)), s) for d, t, s in docs)
    sizes = defaultdict(int)
    for (d, n, s), c in text.items():
        sizes[s] += (n or 0) * c
    want = shares(dict(sizes))
    by_id = {d: (n or 0, s) for (d, n, s) in text}
    taken, largest = Counter(), Counter()
    assert len(rows) == sum(text.values())
    for r in rows:
        n, s = by_id[r.doc_id]
        assert r.size == n and r.source_size == sizes[s]
        assert abs(r.target - want[s]) <= 1e-6 * max(1, want[s])
        assert 0 <= r.taken <= 3 * n and (n == 0 or r.taken % n == 0)
        taken[s] += r.taken
        largest[s] = max(largest[s], n)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6, (s, taken[s], want[s])


def test_mix_of_the_whole_table(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    df = QUERIES["op3_pareto_mix"](spark, SF_CHECK)
    assert df.columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    rows = df.collect()
    check_mix(rows, docs)
    assert sorted(map(tuple, QUERIES["op3_pareto_mix"](spark, SF_CHECK).collect())) == sorted(map(tuple, rows))


def test_mix_hot_source_nulls_and_caps(spark):
    docs = [(i, "w " * (i % 40 + 1), "hot") for i in range(600)]
    docs += [(1000 + i, "w " * 3, f"s{i % 5}") for i in range(40)] + [(2000, None, "empty"), (2001, "", None),
                                                                      (2002, "a b", None), (None, "x y", "s1")]
    check_mix(pareto_mix(make_docs(spark, [(d, t, "en", s) for d, t, s in docs])).collect(), docs)
    assert pareto_mix(make_docs(spark, [])).count() == 0


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_mix_cuts_inside_a_repeated_row(spark, seed):
    docs = [(1, "a b c d e", "s")] * 300 + [(i, "w x y z", "s") for i in range(2, 702)] + [(i, "q " * 40, "t") for i in range(800, 960)]
    df = make_docs(spark, [(d, t, "en", s) for d, t, s in docs]).repartition(6)
    rows = pareto_mix(df, weights=(1, 3), seed=seed).collect()
    assert len(rows) == len(docs)
    for s, longest in (("s", 5), ("t", 40)):
        mine = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= longest / 2 + 1
    mix = Counter(r.doc_id for r in mixed_documents(df, weights=(1, 3), seed=seed).collect())
    taken = Counter()
    for r in rows:
        taken[r.doc_id] += r.copies
    assert mix == +taken


def rate_of(sizes, left, power):
    """The rate by bisection: words expected under min(1, rate * size ** power) equal ``left``."""
    low, high = 0.0, 2.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(s * min(1, mid * s ** power) for s in sizes) < left else (low, mid)
    return low


@pytest.mark.parametrize("power", [0, 0.5, 1])
def test_mix_inclusion_by_size(spark, power):
    """Documents of a size are taken about as often as their probability says; the certain ones always."""
    lengths = [0] * 50 + [1, 4, 9, 16] * 900 + [400] * 2
    docs = [(i, "w " * n, "en", "a") for i, n in enumerate(lengths)] + [(10_000 + i, "q " * 50, "en", "b") for i in range(500)]
    rows = pareto_mix(make_docs(spark, docs), weights=(1, 2), power=power).collect()
    a = [r for r in rows if r.source == "a"]
    left = a[0].target
    assert 0 < left < a[0].source_size
    rate = rate_of([n for n in lengths if n], left, power)
    assert abs(sum(r.taken for r in a) - left) <= 200
    for n in (1, 4, 9, 16):
        share = sum(r.copies for r in a if r.size == n) / 900
        assert abs(share - min(1, rate * n ** power)) < 0.06, (n, share, rate * n ** power)
    if power and rate * 400 ** power >= 1:
        assert all(r.copies == 1 for r in a if r.size == 400)
    if power:
        assert all(r.copies == 0 for r in a if r.size == 0)


def test_mix_takes_whole_source_once_and_certain_documents(spark):
    docs = [(1, "w " * 1000, "en", "a")] + [(i, "w", "en", "a") for i in range(2, 102)] + [(i, "q " * 9, "en", "b") for i in range(200, 400)]
    for seed in range(3):
        rows = pareto_mix(make_docs(spark, docs), weights=(1, 1), power=1, seed=seed).collect()
        a = [r for r in rows if r.source == "a"]
        assert abs(sum(r.taken for r in a) - a[0].target) <= 500


def test_mix_draws_differ_by_seed_and_not_by_run(spark):
    docs = make_docs(spark, [(i, "w w", "en", "a" if i < 300 else "b") for i in range(400)])
    got = [{r.doc_id: r.taken // 2 for r in pareto_mix(docs, weights=(1, 1), seed=s).collect()} for s in (0, 0, 1)]
    assert got[0] == got[1] != got[2]
    assert abs(sum(got[0][i] for i in range(300)) - 200) <= 1


def check_shards(rows, docs, n):
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    slots, load, homes = defaultdict(list), Counter(), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
        homes[r.size, r.text_crc32].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(n))
    return [load[i] for i in range(n)], homes


def test_shards_of_the_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()]
    df = QUERIES["op9_kd_tree_shards"](spark, SF_CHECK)
    assert df.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = df.collect()
    load, homes = check_shards(rows, docs, 8)
    assert max(load) - min(load) <= 0.05 * sum(load) / 8
    assert sum(len(h) > 1 for h in homes.values()) <= 7
    assert {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}


@pytest.mark.parametrize("n", [1, 3, 8])
def test_shards_hot_group_nulls_and_repeats(spark, n):
    docs = [(i, "the same text") for i in range(900)] + [(1000 + i, "w" * (i % 90)) for i in range(1500)]
    docs += [(5000, None), (5000, None), (None, "null id"), (5001, "")]
    load, homes = check_shards(kd_shards(make_docs(spark, docs), shards=n).collect(), docs, n)
    assert max(load) - min(load) <= 0.06 * sum(load) / n + 100
    assert sum(len(h) > 1 for h in homes.values()) < max(n, 1)


def test_shards_by_target_bytes_and_empty(spark):
    docs = make_docs(spark, [(i, "x" * 99) for i in range(400)])
    assert kd_shards(docs, shards=None, target_bytes=4000).select("shard").distinct().count() == 10
    assert kd_shards(make_docs(spark, [])).count() == 0
    plan = kd_shards(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
