"""Token counts against the public tokenizer library."""

import random

import pytest
from tokenizers import Tokenizer

from kpiloom.llm import token_counts as tc
from kpiloom.llm.queries import TOKENIZER, op10_token_counts

tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def model():
    path = tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as f:
        return f.read(), Tokenizer.from_file(path)


def library(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def check(spark, model, texts, parts=4):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in tc.token_counts(docs, model[0]).collect()}
    want = {i: (len((t or "").encode()), n := library(model[1], t), n > 512) for i, t in enumerate(texts)}
    assert {i for i in want if got[i] != want[i]} == set()


def invented(seed, n):
    rnd = random.Random(seed)
    parts = [" ", "  ", "\n", "\r\n", "\t", "'s", "'LL", "don't", "a", "Zebra", "ing", "1", "2024", "é", "ß", "中文", "😀", " ", " ",
             "_", "--", "!?", "́", "﻿", "<|endoftext|>", "<|end", "|>", "\x00", "\x7f", "ǅ", "²", "Ⅷ"]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(0, 60))) for _ in range(n)]


def test_random_strings(spark, model):
    check(spark, model, invented(3, 3000))


def test_every_code_point(spark, model):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    check(spark, model, ["".join(points[i:i + 997]) for i in range(0, len(points), 997)], 16)


def test_chunk_borders_and_long_pieces(spark, model):
    rnd = random.Random(5)
    texts = [" " * k + "word" for k in range(tc.CHUNK - 3, tc.CHUNK + 4)]
    texts += ["x" * k + " y'll" + " " * j for k in (tc.CHUNK - 1, tc.CHUNK, 3 * tc.CHUNK) for j in (0, 1, 2)]
    texts += ["".join(rnd.choice("abcdeé") for _ in range(k)) for k in (5_000, 20_000)] + ["ab" * 10_000, "1" * 9_999, "\n" * 5_000]
    check(spark, model, texts)


def test_nulls_empty_texts_and_empty_table(spark, model):
    check(spark, model, [None, "", " ", "a", None, "a"])
    assert tc.token_counts(spark.createDataFrame([], "doc_id long, text string, n_tokens int"), model[0]).collect() == []


def test_whole_table(spark, model):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = {r.doc_id: r.n_tokens for r in op10_token_counts(spark, d).collect()}
    assert got == {i: library(model[1], t) for i, t in texts.items()}
