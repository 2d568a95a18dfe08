"""Role repair against a shortest-path search over whole audits in plain Python."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from kpiloom.llm import role_repair as rr
from kpiloom.llm.queries import damaged, op11_role_repair

VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(items):
    """(cost, audit, roles) by a search over (rows consumed, phase); phases: 0 nothing, 1 system, 2 user, 3 pair."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, phase, out = heapq.heappop(heap)
        if i == len(items) and phase in (0, 3):
            return cost, audit, out
        if (i, phase) in done:
            continue
        done.add((i, phase))
        after = {0: "u", 1: "u", 2: "a", 3: "u"}[phase]
        heapq.heappush(heap, (cost + 2, audit + "I", i, 3 if after == "a" else 2, (*out, (None, after))))
        if i == len(items):
            continue
        initial, fault = items[i]
        heapq.heappush(heap, (cost + 3, audit + "D", i + 1, phase, out))
        if fault in ("blank", "duplicate"):
            continue
        cut = fault == "truncated"
        heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, 3 if after == "a" else 2, (*out, (i, after))))
        if initial == after:
            heapq.heappush(heap, (cost + cut, audit + "K", i + 1, 3 if after == "a" else 2, (*out, (i, None))))
        if initial == "s" and phase == 0:
            heapq.heappush(heap, (cost + cut, audit + "K", i + 1, 1, (*out, (i, None))))


def plain(rows):
    """conv -> result of rows (conv, turn, role, text), in their order within a turn where that matters."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, rs in convs.items():
        rs.sort(key=lambda r: (r[0], r[1], r[2], r[3][:64], hashlib.md5(f"{r[2]}:{r[3]}".encode()).hexdigest()))
        seen, items = set(), []
        for _, _, role, text in rs:
            marks = VISIBLE.findall(text)
            fault = "blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else ""
            seen.add((role, text))
            items.append((role[:1], fault))
        cost, audit, roles = cheapest(items)
        turns = [r[1] for r in rs if r[0]]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for (a, _), (b, _) in zip(items, items[1:]))
        lines = [f"{'user' if g == 'u' else 'assistant'}:" + ("" if i is None else rs[i][3]) if g else f"{rs[i][2]}:{rs[i][3]}"
                 for i, g in roles]
        count = [sum(f == k for _, f in items) for k in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def made(spark, rows, parts=4):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, place string, at int")
    report, turns = rr.repaired(df.repartition(parts))
    digest = {r.conv_id: r.sha256 for r in rr.digests(turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    got = report.collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: (*[r[c] for c in rr.COUNTS], r.audit, digest.get(r.conv_id, empty)) for r in got}


def invented(seed, n, longest):
    rnd, rows = random.Random(seed), []
    texts = ["Yes.", "no", "", " \t", "Why?", "ok!", "cut , ", "end.\n", None, "é!", " ", "a" * 3000 + "."]
    for conv in [*range(n), None]:
        role, turn = rnd.choice(["system", "user", "user", "assistant"]), rnd.randrange(3)
        for k in range(rnd.randrange(1, longest)):
            say = f"{rnd.choice(['', 'x', 'y'])}{k if rnd.random() < .8 else ''}{t}" if (t := rnd.choice(texts)) and t.strip() else t
            rows.append((conv, None if rnd.random() < .04 else turn, role, say))
            if rnd.random() < .1:
                rows += [rows[-1]] * rnd.randrange(1, 3)
            turn += rnd.choice([0, 1, 1, 1, 1, 2])
            role = {"user": "assistant"}.get(role, "user") if rnd.random() < .8 else rnd.choice(["system", "user", "assistant", "tool", "", None])
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_search(spark, seed):
    rows = invented(seed, 150, 12)
    assert made(spark, rows) == plain(rows)


def test_long_conversation_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(rr, "BLOCK_BITS", 5)
    monkeypatch.setattr(rr, "LONG", 8)
    rows = invented(3, 3, 500) + [(7, 1, "user", "same.")] * 300 + [(7, t, "assistant", "again") for t in range(200)]
    assert made(spark, rows) == plain(rows)


def test_small_and_empty(spark):
    rows = [(1, 0, "system", "only."), (2, 0, "assistant", "only."), (3, 0, "user", " "), (4, None, None, None)]
    assert made(spark, rows) == plain(rows)
    assert made(spark, []) == {}


def test_repaired_turns_follow_the_grammar(spark):
    rows = invented(5, 60, 10)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = {}
    for r in sorted(rr.repaired(df).turns.collect(), key=lambda r: (r.place, r.step)):
        convs[r.conv_id] = convs.get(r.conv_id, "") + r.role[0]
        assert r.action in ("keep", "rerole", "insert") and (r.action != "insert" or r.text == "")
    assert all(re.fullmatch("s?(ua)+", x) for x in convs.values())


def harm(conv, turn, role, text):
    f = lambda v: " " if v is None else str(v)
    k, role, text = zlib.crc32(f"{f(conv)}:{f(turn)}".encode()) % 20, f(role), f(text)
    row = (conv, turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)
    return [row] * {0: 0, 3: 2}.get(k, 1)


def test_query_on_whole_table(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").collect()]
    expected = plain([x for r in rows for x in harm(*r)])
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r.conv_id: (*[r[c] for c in rr.COUNTS], r.audit, r.repaired_sha256) for r in op11_role_repair(spark, d).collect()}
    assert got == {r[0]: expected.get(r[0], nothing) for r in rows}


def test_damage_with_nulls(spark):
    rows = [(c, t, r, x) for c in (None, 1, 2) for t in (None, *range(40)) for r, x in ((None, None), ("user", "a. b!"))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(map(tuple, damaged(df).collect()), key=str) == sorted((x for r in rows for x in harm(*r)), key=str)
