"""Small tables for the training-data operators; the Spark session is the suite's."""

import random

import pytest

DOC_DDL = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ["the", "of", "Sea", "rain", "ño", "über", "mill", "a", "tide", "gråt", "lo.", "under"]


def make_docs(spark, rows, extra=""):
    """(doc_id, text) or (doc_id, text, lang, source) rows as a documents table."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s0",
             None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOC_DDL)


def repeated_texts(seed=0, n=60):
    """Random texts with shared passages, exact and near copies, empties, nulls and a shared id."""
    rnd = random.Random(seed)
    def words(k):
        return [rnd.choice(WORDS) + rnd.choice(["", "", "x", "é", "."]) + str(rnd.randrange(30)) for _ in range(k)]
    passages = [words(rnd.randrange(52, 90)) for _ in range(4)]
    rows = []
    for i in range(n):
        w = words(rnd.randrange(0, 120))
        if rnd.random() < 0.5:
            p = rnd.choice(passages)
            a = rnd.randrange(0, 30)
            w[len(w) // 2:len(w) // 2] = p[a:] if rnd.random() < 0.5 else p
        if rnd.random() < 0.1:
            w = w + w
        rows.append((i * 7 % n, rnd.choice([" ", " ", "\n", "  "]).join(w)))
    rows += [(n, rows[0][1]), (n + 1, rows[3][1] + " tail"), (n + 2, ""), (n + 3, None), (n + 4, "short"),
             (n + 5, "ab" * 400), (n + 6, "ab" * 300), (n + 7, " " * 200), (n + 8, "x" * 300 + " " * 120),
             (None, rows[5][1]), (None, None), (5, rows[9][1]), (5, rows[9][1])]
    return rows


@pytest.fixture(scope="session")
def repeats():
    return repeated_texts()
