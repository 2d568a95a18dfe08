"""Every stage of the pipeline on what its predecessor kept, against plain Python."""

from collections import Counter

import corpus_pipeline as P
from kpiloom.llm.queries import QUERIES
from kpiloom.llm.tables import stored
from tests.conftest import SF_CHECK
from tests.llm.conftest import make_docs
from tests.llm.test_lsh_forest import brute as components_of
from tests.llm.test_mix_shards import check_shards, shares
from tests.llm.test_mix_shards import WORD
from tests.llm.test_simhash_leaks import brute as leaks_of


def test_stages(spark):
    names = [n for n, _ in P.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{SF_CHECK}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r for r in docs.collect()}

    docs = stored(P.toxicity(spark, docs, SF_CHECK))
    scored = {r.doc_id: r.predicted for r in QUERIES["op7_toxicity"](spark, SF_CHECK).collect()}
    kept = docs.collect()
    assert docs.columns == columns and all(r == rows[r.doc_id] for r in kept)
    assert {r.doc_id for r in kept} == {d for d, p in scored.items() if not p}

    docs = stored(P.near_dedup(spark, docs, SF_CHECK))
    want = components_of([(r.doc_id, r.text) for r in kept], k=P.SHINGLE)
    kept = docs.collect()
    assert docs.columns == columns
    assert sorted(r.doc_id for r in kept) == sorted(d for d, (_, c) in want.items() if c == d)

    items = spark.read.parquet(f"{SF_CHECK}/benchmark.parquet").collect()
    bad = {d for d, _ in leaks_of([(r.doc_id, r.text) for r in kept], [(i.item_id, i.text) for i in items])}
    before = {r.doc_id for r in kept}
    docs = stored(P.decontamination(spark, docs, SF_CHECK))
    kept = docs.collect()
    assert bad and docs.columns == columns and {r.doc_id for r in kept} == before - bad

    sizes, by_source = {}, Counter()
    for r in kept:
        sizes[r.doc_id] = len(WORD.findall(r.text))
        by_source[r.source] += sizes[r.doc_id]
    docs = stored(P.mixing(spark, docs, SF_CHECK))
    mixed = docs.collect()
    copies = Counter(r.doc_id for r in mixed)
    assert docs.columns == columns and max(copies.values()) <= 3
    target = shares(dict(by_source))
    taken = Counter()
    for r in mixed:
        taken[r.source] += sizes[r.doc_id]
    assert all(abs(taken[s] - t) <= max(sizes.values()) / 2 + 1 for s, t in target.items())

    load, _ = check_shards(P.sharding(spark, docs, SF_CHECK).collect(), [(r.doc_id, r.text) for r in mixed], 8)
    assert max(load) - min(load) <= 0.06 * sum(load) / 8


def test_run_and_registration(spark):
    import __spark_entry__ as E
    assert E.queries()["pipeline"] is P.run and "pipeline" not in E.oracle_sql()
    out = P.run(spark, "/root/testdata/sf0.001")
    assert out.columns[:2] == ["doc_id", "size"] and out.count() > 0


def test_stages_keep_clean_and_odd_rows(spark):
    """Nulls, empties and shared ids go through every filtering stage."""
    rows = [(1, "alpha beta gamma delta epsilon zeta"), (2, None), (3, ""), (None, "nameless one"), (None, "nameless two"),
            (5, "same row"), (5, "same row"), (5, "other text under the same id")]
    docs = make_docs(spark, rows)
    key = lambda r: (r.doc_id is None, r.doc_id, r.text or "")
    got = sorted(P.near_dedup(spark, docs, SF_CHECK).collect(), key=key)
    assert [(r.doc_id, r.text) for r in got] == [(1, rows[0][1]), (2, None), (3, ""), (5, rows[7][1]), (5, "same row"),
                                                 (None, "nameless one"), (None, "nameless two")]
    assert P.decontamination(spark, docs, SF_CHECK).count() == len(rows)
    assert P.toxicity(spark, docs, SF_CHECK).count() == len(rows)
    assert P.mixing(spark, docs.limit(0), SF_CHECK).count() == 0


def test_columns_of_any_name_stay(spark):
    names = ["_id", "_variant", "id", "src", "h", "row", "node", "Other", "component", "first", "n"]
    docs = make_docs(spark, [(1, "same row"), (2, "same row"), (3, "another")])
    docs = docs.selectExpr("*", *[f"doc_id * 10 + {i} AS `{n}`" for i, n in enumerate(names)])
    for stage in (P.toxicity, P.near_dedup, P.decontamination, P.mixing):
        got = stage(spark, docs, SF_CHECK)
        assert got.columns == docs.columns
        assert all(r[n] == r.doc_id * 10 + i for r in got.collect() for i, n in enumerate(names))


def test_different_texts_under_one_id_stay(spark):
    rows = [(5, "same row"), (5, "same row"), (5, "other text under the same id"), (7, "other text under the same id"),
            (3, "same row"), (None, "same row"), (9, None), (9, "")]
    got = P.near_dedup(spark, make_docs(spark, rows), SF_CHECK).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == [
        (-1, "same row"), (3, "same row"), (5, "other text under the same id"), (9, "")]
