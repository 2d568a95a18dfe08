"""Operator 8 against all pairs of full shingle sets."""

import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq

from kpiloom.llm import lsh_forest
from kpiloom.llm import components as C
from kpiloom.llm.components import components, joined
from kpiloom.llm.lsh_forest import near_duplicates
from kpiloom.llm.queries import QUERIES
from tests.conftest import SF_CHECK
from tests.llm.conftest import make_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def brute(rows, k=4, percent=80):
    """(n, component) by document id, for rows with distinct ids."""
    sets = {}
    for d, t in rows:
        w = WORD.findall(lower(t or ""))
        sets[d] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    by_shingle = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by_shingle[x].append(d)
    for d, s in sets.items():
        both = defaultdict(int)
        for x in s:
            for e in by_shingle[x]:
                both[e] += 1
        for e, c in both.items():
            if e < d and 100 * c >= percent * (len(s) + len(sets[e]) - c):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def near_copies(seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, at = [], 0
    for group in range(40):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 5, 9, 30, 120, 400]))]
        for _ in range(rnd.choice([1, 2, 3, 12, 40])):
            w = list(base)
            for _ in range(rnd.randrange(0, 1 + len(w) // 25)):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            rows.append((at * 13 % 10007, rnd.choice([" ", "\n"]).join(w).title() if rnd.random() < .2 else " ".join(w)))
            at += 1
    return rows


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_equals_brute_force(spark):
    rows = near_copies() + [(20001, ""), (20002, None), (20003, " \n"), (20004, "One two"), (20005, "one TWO"),
                            (20006, "one"), (20007, "É é"), (20008, "é é")]
    assert result(near_duplicates(make_docs(spark, rows).repartition(5))) == brute(rows)


def test_whole_table_equals_brute_force(spark):
    t = pq.read_table(f"{SF_CHECK}/documents.parquet", columns=["doc_id", "text"])
    want = brute(list(zip(t["doc_id"].to_pylist(), t["text"].to_pylist())))
    df = QUERIES["op8_minhash_near_dedup"](spark, SF_CHECK)
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = df.collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_hot_group_travels_in_part(spark):
    """More near copies than HOT in a task: still one component."""
    rnd = random.Random(4)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        w = list(base)
        w[rnd.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(w)))
    got = result(near_duplicates(make_docs(spark, rows).repartition(3)))
    assert {c for _, c in got.values()} == {0}


def test_null_ids_repeated_rows_and_empty(spark):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (9, "z")]
    got = sorted((r.doc_id or -1, r.component_id, r.kept) for r in near_duplicates(make_docs(spark, rows)).collect())
    assert [(a, c) for a, _, c in got] == [(-1, True), (3, True), (7, False), (7, False), (9, True)]
    assert [b for _, b, _ in got] == [None, 3, 3, 3, 9]
    assert near_duplicates(make_docs(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(51)}, **{100 + i: 100 for i in range(30)}}


def test_more_links_run_on_components_only(spark, monkeypatch):
    """New links join whole components; the driver's garbage goes every round, and no round runs without a new link."""
    calls, freed = [], []
    monkeypatch.setattr(C, "components", lambda links, run=C.components: calls.append(links.count()) or run(links))
    monkeypatch.setattr(C, "released", lambda spark, run=C.released: freed.append(1) or run(spark))
    links = lambda *rows: spark.createDataFrame(rows, "a long, b long")
    first = [(10, 11), (11, 12), (12, 13), (20, 21), (21, 22), (40, 41)]
    found = joined(None, links(*first))
    assert joined(found, links()) is found and joined(found, links((13, 10), (20, 22))) is found
    assert calls == [6] and freed
    more = [(13, 22), (12, 21), (5, 22), (7, 8), (41, 30)]
    got = sorted(tuple(r) for r in joined(found, links(*more)).collect())
    assert got == sorted(tuple(r) for r in components(links(*first, *more)).collect())
    assert calls == [6, 4]                           # (13, 22) and (12, 21) join the same two components


def wide_family(seed=6, n=2000, planted=150):
    """Texts of 200 shingles, two of them 0.72 to 0.79 similar; ``planted`` ones are 0.82 similar to one other text."""
    rnd = random.Random(seed)
    slots, used, family = range(3, 203, 4), set(), []
    threes = lambda own: set(itertools.combinations(sorted(own), 3))
    while len(family) < n:
        own = rnd.sample(slots, 4)
        if not used & threes(own):
            used |= threes(own)
            family.append(own)
    for own in rnd.sample(family, planted):
        again = rnd.choice([[*own[:3], x] for x in slots if x not in own
                            and used & threes([*own[:3], x]) == threes(own[:3])])
        used |= threes(again)
        family.append(again)
    rnd.shuffle(family)
    base = [f"w{i}" for i in range(203)]
    return [(i, " ".join(f"x{i}" if at in own else w for at, w in enumerate(base))) for i, own in enumerate(family)]


def components_by_matrix(rows, k=4, percent=80):
    """Component by document id, from all pairs at once."""
    sets = [{" ".join(w[i:i + k]) for i in range(len(w) - k + 1)} for w in (t.split() for _, t in rows)]
    count = Counter(x for s in sets for x in s)
    column = {x: c for c, x in enumerate(x for x, times in count.items() if times > 1)}
    held = np.zeros((len(rows), len(column)), np.float32)
    for r, s in enumerate(sets):
        held[r, [column[x] for x in s if x in column]] = 1
    both, size = (held @ held.T).astype(int), np.array([len(s) for s in sets])
    out = np.array([d for d, _ in rows])
    a, b = np.nonzero(100 * both >= percent * (size[:, None] + size - both))
    while True:
        new = out.copy()
        np.minimum.at(new, a, out[b])
        if (new == out).all():
            return dict(zip((d for d, _ in rows), out.tolist()))
        out = new


def test_isolated_links_of_a_wide_family(spark):
    """Regions of hundreds of texts just under the threshold hide no link."""
    rows = wide_family()
    want = components_by_matrix(rows)
    assert len(set(want.values())) == 2000 and len(rows) == 2150
    got = result(near_duplicates(make_docs(spark, rows).repartition(6)))
    assert {d: c for d, (_, c) in got.items()} == want


def test_places_of_a_large_region_are_bounded():
    """20,000 documents in 2,000 components: each pair to compare meets in one place, and no place grows."""
    rnd = np.random.default_rng(5)
    n = 20_000
    ids, group = rnd.permutation(n) * 7, np.concatenate([np.zeros(n // 4), rnd.integers(1, 2000, n - n // 4)]).astype(np.int64)
    others = int((group != 0).sum())
    fill = lambda v: np.full(n, v, np.int64)
    row, place, role = (np.concatenate(c) for c in zip(*lsh_forest.tiles(fill(99), fill(n), fill(others), fill(0), ids, group)))
    _, at, size = np.unique(place, return_inverse=True, return_counts=True)
    looks, seen = -(-others // lsh_forest.CHUNK), -(-n // lsh_forest.CHUNK)
    assert size.max() < 2.4 * lsh_forest.CHUNK and len(size) == looks * seen
    assert len(row) == (n - others) * looks + others * (looks + seen - 1)
    some = rnd.choice(np.flatnonzero(group != 0), 40, replace=False)
    look_role = (role == 1) | (role == 2)
    for u in some:                                   # a looker meets every document once
        mine = np.isin(at, at[look_role & (row == u)]) & (role != 1)
        assert np.array_equal(np.sort(row[mine]), np.arange(n))


def test_tiled_region_hides_no_link(spark, monkeypatch):
    """The looking side in several chunks, places in several buckets of a task: the same components."""
    monkeypatch.setattr(lsh_forest, "CHUNK", 64)
    monkeypatch.setattr(lsh_forest, "BUCKET_ROWS", 2000)
    rows = wide_family(seed=9, n=500, planted=60)
    want = components_by_matrix(rows)
    got = result(near_duplicates(make_docs(spark, rows).repartition(6)))
    assert {d: c for d, (_, c) in got.items()} == want
