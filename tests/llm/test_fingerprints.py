from __future__ import annotations

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from oreworks.llm import fingerprints
from oreworks.llm.catalog import QUERIES

from .conftest import documents


def fingerprint(text):
    words = (text or "").lower().split()
    pairs = [words[i : i + 2] for i in range(max(1, len(words) - 1))] if words else []
    total, votes = 0, [0] * 64
    for pair in pairs:
        weight = 1 + sum(len(w) >= 4 for w in pair)
        h = xxhash.xxh64_intdigest(" ".join(pair), seed=42)
        total += weight
        for b in range(64):
            votes[b] += weight * (h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * votes[b] > total)


def edited(texts):
    out = []
    for i, text in enumerate(texts):
        k, following = len(text) // 4, texts[(i + 1) % len(texts)]
        out.append(text[: len(text) - k] + following[:k])
    return out


def likeness(a, b):
    return 1 - (a ^ b).bit_count() / 64


def test_whole_table_against_brute_force(spark, sf_dir):
    rows = sorted(QUERIES["op6_document_fingerprints"](spark, sf_dir).collect(), key=lambda r: r.doc_id)
    docs = sorted(documents(spark, sf_dir).collect(), key=lambda r: r.doc_id)
    texts = [r.text for r in docs]
    assert [r.doc_id for r in rows] == [r.doc_id for r in docs]
    own, changed = [fingerprint(t) for t in texts], [fingerprint(t) for t in edited(texts)]
    for i, (r, text) in enumerate(zip(rows, edited(texts), strict=True)):
        assert r.n_chars == len(texts[i])
        assert r.edited_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (int(r.fingerprint, 16), int(r.edited_fingerprint, 16)) == (own[i], changed[i])
        assert r.near_edited == pytest.approx(likeness(own[i], changed[i]))
        assert r.near_next == pytest.approx(likeness(own[i], own[(i + 1) % len(own)]))
        assert r.n_near == sum((own[i] ^ f).bit_count() <= 3 for f in set(own)) - 1
    # An edited text is liker than the next document, nearly always.
    assert sum(r.near_edited > r.near_next for r in rows) > 0.95 * len(rows)


def test_successors_over_sparse_and_negative_ids(spark):
    ids = [-1000, -5, 0, 1, 127, 128, 129, 5000, 10**15]
    texts = [f"text number {i} with some words {'y' * (k * 7)}" for k, i in enumerate(ids)]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.edited for r in fingerprints.edited_texts(docs).collect()}
    assert got == dict(zip(ids, edited(texts), strict=True))
    one = fingerprints.edited_texts(docs.where("doc_id = 0")).collect()
    assert [r.edited for r in one] == edited([texts[2]])


def test_bucket_ends_without_broadcast(spark, monkeypatch):
    docs = spark.range(0, 2000, 37).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text of "), "id").alias("text"))
    want = sorted((r.doc_id, r.edited) for r in fingerprints.edited_texts(docs).collect())
    monkeypatch.setattr(fingerprints, "BROADCAST_ENDS", 0)
    assert sorted((r.doc_id, r.edited) for r in fingerprints.edited_texts(docs).collect()) == want


def test_awkward_rows(awkward, no_docs):
    rows = fingerprints.fingerprint_digest(awkward).collect()
    assert len(rows) == 12
    empty = [r for r in rows if r.doc_id in (2, 3, 4)]
    assert [r.fingerprint for r in empty] == [0, 0, 0] and sorted(r.n_chars for r in empty) == [0, 0, 4]
    alone = [r for r in rows if r.doc_id is None]
    assert all(r.near_next is None and r.near_edited == 1 for r in alone) and len(alone) == 2
    one, again = (r for r in rows if r.doc_id == 1)
    assert one.fingerprint == again.fingerprint
    assert fingerprints.fingerprint_digest(no_docs).count() == 0


@pytest.mark.parametrize(("radius", "blocks"), [(0, 1), (1, 2), (3, 5), (5, 8)])
def test_search_finds_all_within_the_radius(spark, radius, blocks):
    rnd = random.Random(radius)
    prints = {0, (1 << 64) - 1}
    for _ in range(30):
        f = rnd.getrandbits(64)
        for n in range(radius + 3):
            g = f
            for bit in rnd.sample(range(64), n):
                g ^= 1 << bit
            prints.add(g)
    signed = [f - (1 << 64) if f >> 63 else f for f in prints]
    df = spark.createDataFrame([(f,) for f in signed], "fingerprint long")
    queries = df.where(F.pmod("fingerprint", F.lit(2)) == 0)
    mask = (1 << 64) - 1
    bits = lambda a, b: ((a ^ b) & mask).bit_count()
    want = sorted((a, b, bits(a, b)) for a in signed if a % 2 == 0 for b in signed if bits(a, b) <= radius)
    assert sorted(map(tuple, fingerprints.within_radius(queries, df, radius, blocks).collect())) == want


def test_radius_needs_more_blocks(spark):
    with pytest.raises(ValueError):
        fingerprints.within_radius(None, None, 3, 3)


def test_heavy_counts_do_not_overflow(spark):
    """A text of far more terms than a chunk holds."""
    text = "alpha bravo " * 30_000 + "gamma " * 10
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert fingerprints.text_fingerprints(docs, ["doc_id"]).first().fingerprint & ((1 << 64) - 1) == fingerprint(text)
