"""Personal data: known forms and the scored graph, against plain Python."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest

from kpiloom.llm import private_spans as ps
from kpiloom.llm.queries import op12_private_spans

FORMS = [re.compile(p) for p in (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
                                 r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                                 r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def proper(kind, s):
    digits = re.sub("[^0-9]", "", s)
    return [True, all(int(p) <= 255 for p in s.split(".")) if kind == 1 else True,
            13 <= len(digits) <= 19 and luhn(digits), 9 <= len(digits) <= 15][kind]


def base(text):
    return sorted((k, m.start(), m.end()) for k, f in enumerate(FORMS) for m in f.finditer(text) if proper(k, m.group()))


def spans(df):
    return sorted(((r[0], tuple(map(tuple, r.base)), tuple(map(tuple, r.spans))) for r in df.collect()), key=str)


ODD = ["", None, "a@b.com_x@c.org a@b@c.de .a@b.c. a@b..c", "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255 1.2.3.4.", "4539578763621486 4539-5787 6362-1486",
       "+1 (269) 555-3296 4524132264652876", "+1 23456789- +12+345678901 + 1", "😀 a@b.co 😀 1.2.3.4 \U0001d7d9", "5 -4539578763621486",
       "4539578763621486 45395787636214861234567 1 2 3 4 5 6 7 8 9 0 1 2 3 4", "x" * 5_000 + "@" + "a." * 3_000 + " 9" * 2_000,
       "1" * 3_000 + " " + "a@b.c " * 1_500, "a.b@" * 2_000, "+1" + "-" * 3_000 + " +44 20 7946 0958"]


def test_known_forms_equal_plain_search(spark):
    rnd = random.Random(4)
    parts = ["a", "b-c", "@", ".", "1", "25", "256", " ", "-", "+", "(", ")", "_", "é", "😀", "4539578763621486", "\n", "x.y", "%"]
    texts = ODD + ["".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 80))) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.base] for r in ps.personal_spans(docs).collect()}
    assert got == {i: base(t or "") for i, t in enumerate(texts)}


def patterns(left, right):
    def words(s):
        s = re.sub("[0-9]", "0", re.sub(r"\s+", " ", s).strip(" ").lower())
        return [w for w in s.split(" ") if w]
    lw, rw = words(left), words(right)
    out = []
    if lw:
        out.append(f"{lw[-1]} _ ")
    if len(lw) > 1:
        out.append(f"{lw[-2]} {lw[-1]} _ ")
    if rw:
        out.append(f" _ {rw[0]}")
    if lw and rw:
        out.append(f"{lw[-1]} _ {rw[0]}")
    return out


def contexts(text, matches):
    """(start, end, value, left, right): the words stand in the text between two matches of one search."""
    at = [(0, 0)] + matches + [(len(text), len(text))]
    return [(s, e, text[s:e].lower(), text[at[i][1]:s][-ps.CONTEXT:], text[e:at[i + 2][0]][:ps.CONTEXT])
            for i, (s, e) in enumerate(matches)]


def plain(texts):
    """Added spans per text, by dictionaries over all mentions."""
    mentions = set()
    unknown = re.compile(FORMS[3].pattern + r"|(?<!\S)(?=[^\s0-9@]*[0-9@])\S{6,}|(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){5,}")
    for i, t in enumerate(texts):
        t, known = t or "", base(t or "")
        for k, f in enumerate(FORMS):
            # a card's neighbours are other runs of 13 to 19 digits
            found = [m.span() for m in f.finditer(t) if k != 2 or 13 <= len(re.sub("[^0-9]", "", m.group())) <= 19]
            mentions |= {(i, k, *c) for c in contexts(t, found) if (k, c[0], c[1]) in known}
        for c in contexts(t, [m.span() for m in unknown.finditer(t)]):
            if not any(s < c[1] and e > c[0] for _, s, e in known):
                mentions.add((i, None, *c))
    edges = {(p, v, k) for _, k, _, _, v, l, r in mentions for p in patterns(l, r)}
    seeds = defaultdict(set)
    for p, v, k in edges:
        if k is not None:
            seeds[p, k].add(v)
    kept = {p for (p, _), vs in seeds.items() if len(vs) >= ps.SUPPORT}
    edges = {e for e in edges if e[0] in kept}
    links, extracted = {(p, v) for p, v, _ in edges}, defaultdict(set)
    for p, v in links:
        extracted[p].add(v)
    known = {(v, k): 1.0 for _, v, k in edges if k is not None}
    names = {v for v, _ in known}
    unseen, joined = {(p, v) for p, v, k in edges if k is None and v not in names}, {}
    for _ in range(ps.ROUNDS):
        hit = defaultdict(list)
        for (v, k), s in {**known, **joined}.items():
            for p in (p for p, w in links if w == v):
                hit[p, k].append(s)
        conf = {(p, k): sum(x) / (len(extracted[p]) + 1) for (p, k), x in hit.items() if len(x) >= ps.SUPPORT}
        score = defaultdict(float)
        for p, v in unseen:
            for (q, k), c in conf.items():
                if q == p and c >= ps.CONFIDENCE:
                    score[v, k] += math.log(1 - c)
        best = {}
        for (v, k), s in score.items():
            if 1 - math.exp(s) >= ps.ACCEPTED:
                best[v] = max(best.get(v, (0, 0)), (1 - math.exp(s), -k))
        joined = {(v, -k): s for v, (s, k) in best.items()}
    kinds = {v: k for v, k in joined}
    return [{(kinds[v], s, e) for j, k, s, e, v, _, _ in mentions if j == i and k is None and v in kinds} for i in range(len(texts))]


def corpus():
    rnd = random.Random(9)
    texts = []
    for i in range(60):
        a, b = "".join(rnd.choice("abcdef") for _ in range(6)), rnd.randrange(10, 99)
        texts.append(f"On day {i % 3} she said reach me at {a}.{b}@mail.org or else. Some {i} words follow here")
        texts.append(f"server host is 10.{b}.3.{i} today and room r{b:04d}x is free")
    texts += ["please reach me at john77(at)mail.org or else", "please reach me at jane#12345 or else go",
              "now host is fe80::1:ab12 today and so on", "the room r0001x is free", "reach me at  john77(at)mail.org", "x john77(at)mail.org"]
    return texts


def test_long_runs_are_searched_in_linear_time(spark):
    texts = ["x" * 300_000 + "@", "1" * 300_000, "a." * 150_000, "@" + "b." * 150_000, "+1" + "-" * 300_000, "1." * 150_000, "1 " * 150_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: len(r.base) for r in ps.personal_spans(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: 37_500, 6: 0}


def test_found_spans_equal_plain_graph(spark):
    texts = corpus()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    expected = plain(texts)
    assert sum(map(len, expected)) >= 4
    got = {r.doc_id: ({tuple(x) for x in r.spans} - {tuple(x) for x in r.base}, r.spans == sorted(r.spans)) for r in ps.personal_spans(docs).collect()}
    assert got == {i: (e, True) for i, e in enumerate(expected)}
    assert any("john77" in texts[i][s:e] for i, f in enumerate(expected) for _, s, e in f)
    assert not any("r0001x" in texts[i][s:e] for i, f in enumerate(expected) for _, s, e in f)


def test_repeated_rows_shared_ids_and_clashing_columns(spark):
    text = "mail a.b@c.de now"
    rows = [(1, text, 1, "a"), (1, text, 2, "b"), (1, "other 1.2.3.4", 3, "c"), (None, text, 4, "d"), (None, None, 5, "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, known string")
    got = spans(ps.personal_spans(docs))
    assert got == sorted([(i, tuple(base(t or "")), tuple(base(t or ""))) for i, t, _, _ in rows], key=str)
    assert ps.personal_spans(docs.limit(0)).collect() == []


@pytest.mark.parametrize("d", ["/root/testdata/sf0.001"])
def test_query_on_whole_table(spark, d):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = op12_private_spans(spark, d).collect()
    assert len(got) == len(docs)
    for r in got:
        b = base(docs[r.doc_id] or "")
        line = ",".join(f"{ps.KINDS[k]}:{s}:{e}" for k, s, e in b)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in b) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(line.split(",")) - {""} <= set(r.spans.split(","))
