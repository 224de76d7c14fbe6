from __future__ import annotations

import random
import re
from collections import Counter
from math import floor, log

import numpy as np
import pyarrow as pa
import pytest

from oreworks.llm import byte_tokens, k2_treap

from ..oracle_compare import connect, duck_rows, spark_rows
from .conftest import documents

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k=20):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text))
            if score > 0:
                found.append((-score, doc is None, doc))
        out += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def check(spark, docs, items, k=20):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in k2_treap.ranked_documents(d, i, k).collect()]
    assert sorted(got, key=repr) == ranked(docs, items, k)


def test_terms():
    texts = ["Don't STOP", None, "", "é漢x9 ..!", "a", "b", "ÉÀ_z\x00y"]
    words, of = k2_treap.terms_of(pa.array(["skipped", *texts]).slice(1))
    got = [[w.decode() for w, k in zip(words.to_pylist(), of, strict=True) if k == i] for i in range(len(texts))]
    assert got == [terms(t) for t in texts]
    assert k2_treap.terms_of(pa.array([None, ""], pa.string()))[0].to_pylist() == []


@pytest.mark.parametrize("seed", range(10))
def test_tree_finds_the_best_columns(seed, monkeypatch):
    rnd = np.random.default_rng(seed)
    monkeypatch.setattr(k2_treap, "RANGE_BITS", int(rnd.integers(1, 6)))
    monkeypatch.setattr(k2_treap, "FIRST_RANGES", 2)
    n_rows, n_columns = int(rnd.integers(1, 70)), int(rnd.integers(1, 90))
    grid = rnd.integers(1, 50, (n_rows, n_columns)) * (rnd.random((n_rows, n_columns)) < 0.2)
    rows, columns = np.nonzero(grid)
    if not len(rows):
        return
    tree = k2_treap.K2Treap(rows, columns, grid[rows, columns], max(n_rows, n_columns, 2))
    for k in (1, 5, 200):
        asked = rnd.choice(n_rows, min(n_rows, 6), replace=False)
        weights = rnd.integers(1, 9, len(asked))
        scores = weights @ grid[asked]
        found, values = tree.best(asked, weights, k, np.empty(0))
        assert dict(zip(found.tolist(), values.tolist(), strict=True)).items() <= {c: s for c, s in enumerate(scores.tolist()) if s}.items()
        positive = np.sort(scores[scores > 0])
        least = positive[-k] if len(positive) >= k else 1
        assert set(np.flatnonzero(scores >= least)) <= set(found.tolist())
        # A k-th best score known from elsewhere leaves out what is below it, and nothing else.
        high = np.full(k, float(scores.max()))
        assert set(tree.best(asked, weights, k, high)[0].tolist()) >= set(np.flatnonzero(scores == scores.max())) - ({*range(n_columns)} if not scores.max() else set())


def test_against_sql(spark, sf_dir):
    got = k2_treap.ranked_documents(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    assert spark_rows(got) == duck_rows(connect(sf_dir), k2_treap.oracle_sql())


def test_random_tables(spark, monkeypatch):
    monkeypatch.setattr(byte_tokens, "SLICE_BYTES", 900)
    monkeypatch.setattr(k2_treap, "ITEMS_AT_ONCE", 4)
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(40)] + ["Ünï", "漢字", "THE", "the", "9"]
    text = lambda n: rnd.choice([" ", ", "]).join(rnd.choices(words, range(1, len(words) + 1), k=n))
    docs = [(i, text(rnd.choice([1, 3, 30, 200]))) for i in range(150)]
    docs += [(200 + k, docs[3][1]) for k in range(30)]
    check(spark, docs, [(k, text(rnd.randint(1, 12))) for k in range(9)])


def test_nulls_ties_repeats_and_long_texts(spark):
    docs = [(5, "alpha beta"), (5, "alpha beta"), (None, "alpha beta"), (3, "alpha"), (7, None), (8, ""), (9, "... !"), (10, "beta " * 50_000), (-4, "alpha beta"), (11, "x" * 100_000)]
    items = [(1, "alpha alpha beta"), (1, "alpha alpha beta"), (None, "beta"), (2, None), (3, ""), (4, "unknown"), (5, "x" * 100_000)]
    check(spark, docs, items)
    check(spark, docs, items, k=2)
    check(spark, [(1, "all all")], [(1, "all")])


def test_empty_and_clashing_columns(spark, awkward, no_docs):
    items = spark.createDataFrame([(1, "alpha gamma", 5, 6)], "item_id long, text string, item long, rank long")
    docs = awkward.selectExpr("*", "1 AS score", "2 AS item")
    got = k2_treap.ranked_documents(docs, items).collect()
    assert sorted(map(tuple, got), key=repr) == ranked([(r.doc_id, r.text) for r in awkward.collect()], [(1, "alpha gamma")])
    assert k2_treap.ranked_documents(no_docs, items).count() == 0
    assert k2_treap.ranked_documents(docs, items.where("item_id > 1")).count() == 0
