"""Merkle manifest against a plain recursion, with nulls, ties, repeated rows and several fans."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from kpiloom.llm import merkle_manifest as mm
from kpiloom.llm.queries import op13_merkle_manifest


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(values):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fan):
    """(top, proof of every node)."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i // fan * fan
            proofs[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + fan])))
        nodes = [h("".join(nodes[i:i + fan])) for i in range(0, len(nodes), fan)]
        at = [i // fan for i in at]
    return nodes[0], proofs


def plain(rows, fan=2):
    """(doc_id, leaf, subroot, root, proof) of rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops = {g: climb([x[2] for x in sorted(groups[g])], fan) for g in names}
    root, above = climb([tops[g][0] for g in names], fan)
    return sorted((str(i if given else None), lf, tops[g][0], root, tuple(p + above[k]))
                  for k, g in enumerate(names) for (given, i, lf), p in zip(sorted(groups[g]), tops[g][1]))


def made(spark, rows, fan=2):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string, leaf int, grp string")
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, tuple((s.before, s.after) for s in r.proof))
                  for r in mm.merkle_manifest(docs, fan=fan).collect())


def table(n):
    rows = [(i * 7919 % n, f"s{i % 3}", ["en", "fr", "é", "", None][min(i % 11, 4)], i, "wort " * (i % 5)) for i in range(n)]
    return rows + [(None, None, None, None, None), (3, "s", "en", 1, "tie"), (3, "s", "en", 1, "tie"),
                   (3, None, "en", None, ""), (1, "s", "solo", 5, "ß" * 70_000)]


@pytest.mark.parametrize("n,fan", [(150, 2), (700, 3), (5, 2)])
def test_equals_plain_recursion(spark, n, fan):
    rows = table(n)
    assert made(spark, rows, fan) == plain(rows, fan)


def test_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(mm, "BLOCK", 4)
    rows = table(300)
    assert made(spark, rows) == plain(rows)


def test_small_and_empty(spark):
    one = [(1, "s", "en", 1, "a")]
    assert made(spark, one) == plain(one)
    assert made(spark, one)[0][4] == ()
    assert made(spark, []) == []


def test_query_on_whole_table(spark):
    d = "/root/testdata/sf0.001"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    expected = {r[0]: r for r in plain([(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.values()])}
    got = op13_merkle_manifest(spark, d).collect()
    assert len(got) == len(docs)
    for r in got:
        _, lf, subroot, root, proof = expected[str(r.doc_id)]
        x = docs[r.doc_id]
        tampered = zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        at = leaf((x.doc_id, x.source, x.lang, x.n_chars + 1, x.text)) if tampered else lf
        for before, after in proof:
            at = h(before + at + after)
        assert (r.leaf, r.subroot, r.root, r.proof_sha256) == (lf, subroot, root, h("".join(a + b for a, b in proof)))
        assert (r.folded_root, r.verified) == (at, at == root) and r.verified == (not tampered)


def test_group_key_orders_null_first(spark):
    got = spark.createDataFrame([("b",), (None,), ("",)], "g string").select(mm._group_key(F.col("g")).alias("k")).collect()
    assert sorted(r.k for r in got) == ["0", "1", "1b"]
