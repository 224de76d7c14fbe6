from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from oreworks.llm import token_counts

from .conftest import documents

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(FILE)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_random_texts_equal_the_library(library):
    counter = token_counts.counter_of(FILE)
    rnd = random.Random(1)
    letters = list("abcdefgh  \n\t'sdtreSTX019.,!?éñßÜ–漢字🙂\x1c\x85́") + ["<|endoftext|>", "'ll", " the", "aaaa", "   "]
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40)))
        assert counter.count(text) == library(text), text


def test_one_very_long_word(library):
    counter = token_counts.counter_of(FILE)
    for text in ("ab" * 40_000, "z" * 50_001, "=" * 10_000, "x1" * 5_000):
        assert counter.count(text) == library(text)


def test_merging_by_hand():
    """Pairs merge by rank, then from the left: abab with ab before ba, and aaa as aa a."""
    counter = token_counts.PairCounter([("a", "b"), ("ab", "ab"), ("a", "a"), ("b", "a")], [])
    assert [counter.merged(x) for x in (b"abab", b"aaa", b"ba", b"c", b"")] == [1, 2, 1, 1, 0]


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED_PIECES", 5)
    counter = token_counts.counter_of.__wrapped__(FILE)
    text = " ".join(f"word{i}x" for i in range(50))
    assert counter.count(text) == library(text) and len(counter.known) <= 5


def test_documents(spark, sf_dir, library):
    docs = documents(spark, sf_dir)
    rows = token_counts.token_counts(docs, FILE, 1024).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == len(texts)
    for r in rows:
        n = library(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)


def test_awkward_rows(awkward, no_docs, library):
    got = token_counts.token_counts(awkward, FILE, 10).collect()
    want = [(r.doc_id, len((r.text or "").encode()), library(r.text)) for r in awkward.collect()]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(no_docs, FILE, 10).count() == 0
