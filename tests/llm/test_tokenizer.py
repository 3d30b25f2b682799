from __future__ import annotations

import base64
import os

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from wavequarry.llm import tokenizer

pytestmark = pytest.mark.skipif(not os.path.exists(tokenizer.VOCABULARY), reason="no vocabulary")


@pytest.fixture(scope="module")
def encoders():
    with open(tokenizer.VOCABULARY, "rb") as file:
        data = file.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    return tokenizer.Encoder(data), tiktoken.Encoding("plain", pat_str=tokenizer.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


CASES = ["", " ", "a", "it's we'll", "<|endoftext|>", "\x00\xff", "aaaa" * 5000, " " * 3000, "0123456789" * 900, "中文没有空格" * 400, "naïve 👩‍🔬️ ​﻿", "\r\n\t x\n\n y", "ÃƒÂ©", "qzxjkv" * 3000]


@pytest.mark.parametrize("text", CASES)
def test_cases(encoders, text):
    mine, plain, _ = encoders
    assert mine.encode(text) == plain.encode_ordinary(text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet="abcdeinorst 'AI.1", max_size=120))
def test_same_as_the_merges(encoders, text):
    mine, plain, ranks = encoders
    ids = mine.encode(text)
    assert ids == plain.encode_ordinary(text)
    back = {v: k for k, v in ranks.items()}
    assert b"".join(back[i] for i in ids).decode() == text


def test_memories_may_run_full(encoders, monkeypatch):
    mine, plain, _ = encoders
    monkeypatch.setattr(tokenizer, "MEMORY", 3)
    text = "several different words, and some of them again: several different words"
    assert mine.encode(text) == plain.encode_ordinary(text)


def test_corpus(spark, encoders):
    texts = [*CASES, None, CASES[3]]
    rows = spark.createDataFrame([(k, t, "clash", k) for k, t in enumerate(texts)], "doc_id bigint, text string, ids string, id int")
    got = {r["doc_id"]: r["ids"] for r in tokenizer.encode_corpus(rows, "doc_id", "text").collect()}
    assert got == {k: encoders[1].encode_ordinary(t or "") for k, t in enumerate(texts)}
    assert tokenizer.encode_corpus(rows.limit(0), "doc_id", "text").count() == 0
    assert tokenizer.encode_corpus(rows, "doc_id", "text").dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]


def test_vocabulary_must_be_bounded(spark, monkeypatch):
    monkeypatch.setattr(tokenizer, "VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError, match="larger"):
        tokenizer.encode_corpus(spark.createDataFrame([(1, "a")], "doc_id int, text string"), "doc_id", "text")
