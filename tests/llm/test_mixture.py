from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from oreworks.llm import byte_tokens, mixture

from .conftest import documents

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


def ids_of(library, text):
    return [*(library.encode(text, add_special_tokens=False).ids if text else []), 0]


def test_encoder_equals_the_library(library):
    encoder = byte_tokens.byte_encoder(FILE)
    rnd = random.Random(2)
    letters = list("abcdefABC  \n\t'sdtreSTX019.,!?_éÑßÜİıΣσ–漢字🙂\x1c\x85́²½ªǅŉ<|>　\xa0\U00018eda铡") + ["<|endoftext|>", "'ll", "aaaa", "  "]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(4000)] + [None, "", " ", "x" * 5000]
    ids, ends = encoder.encode(pa.array(texts, pa.string()), 0)
    for text, first, end in zip(texts, [0, *ends], ends, strict=False):
        assert ids[first:end].tolist() == ids_of(library, text), text


def one_by_one(tokens, weights):
    """The queue of each output token: that whose next token is due first, by what the queues have served since one of them ended."""
    left, served, out = list(tokens), [0] * len(tokens), []
    while any(left):
        active = [w if n else 0 for w, n in zip(weights, left, strict=True)]
        if not any(active):
            weights = active = list(left)
            served = [0] * len(tokens)
        due = {q: (Fraction(2 * served[q] + 1, 2) / active[q], q) for q in range(len(tokens)) if active[q]}
        time, q = min(due.values())
        out.append(q)
        left[q], served[q] = left[q] - 1, served[q] + 1
        if not left[q] and any(left) and weights != tokens:
            # All that is due by then is served first; the others start anew.
            for k, _ in sorted((k, 0) for k, (d, _) in due.items() if d == time and k != q):
                out.append(k)
                left[k], served[k] = left[k] - 1, served[k] + 1
            served = [0] * len(tokens)
    return out


@pytest.mark.parametrize("seed", range(25))
def test_plan_places_every_token_once(seed):
    rnd = random.Random(seed)
    size = rnd.choice([4, 16, 1024])
    tokens = [rnd.choice([0, 1, 3, 50, 700, 4000]) for _ in range(rnd.randint(1, 6))]
    weights = None if seed % 3 else [Fraction(rnd.choice([0, 1, 2, 0.5, 40])) for _ in tokens]
    plan = mixture.RoundRobin(tokens, weights, size)
    place, served = {}, defaultdict(Counter)
    for queue, n in enumerate(tokens):
        at = 0
        while at < n:
            some = min(n - at, rnd.choice([1, 5, 300]))
            row, *spans = (x.tolist() for x in plan.slices(np.array([queue]), np.array([at]), np.array([some])))
            spans = list(zip(*spans, strict=True))
            assert sum(s[0] for s in spans) == some and set(row) == {0}
            for length, sequence, offset in spans:
                for k in range(length):
                    assert (sequence, offset + k) not in place
                    place[sequence, offset + k] = queue
                served[sequence][queue] += length
            at += some
    lengths = Counter(sequence for sequence, _ in place)
    assert sorted(place) == [(s, k) for s in sorted(lengths) for k in range(lengths[s])]
    assert all(n == size or n & (n - 1) == 0 and n < size for n in lengths.values())
    order = one_by_one(tokens, [Fraction(w) for w in weights or tokens])
    at = 0
    for sequence in sorted(lengths):
        assert served[sequence] == Counter(order[at : at + lengths[sequence]]), sequence
        at += lengths[sequence]


def check(rows, docs, library, size=1024):
    got, want = defaultdict(list), defaultdict(list)
    for i, text in docs:
        want[i].append(ids_of(library, text))
    for r in rows:
        assert 0 < r.length and 0 <= r.offset and r.offset + r.length <= size
        got[r.doc_id].append((r.doc_tokens, r.start, r.length, r.ids_crc32))
    spans = defaultdict(list)
    for r in rows:
        spans[r.sequence_id].append((r.offset, r.length))
    for placed in spans.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at == size or at & (at - 1) == 0
    assert set(got) == set(want)
    for i, texts in want.items():
        assert sum(n for _, _, n, _ in got[i]) == sum(map(len, texts))
        if len(texts) == 1:
            ids, at = texts[0], 0
            for total, start, n, crc in sorted(got[i], key=lambda x: x[1]):
                assert (total, start) == (len(ids), at)
                assert crc == zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())
                at += n
    return spans


def test_whole_table(spark, sf_dir, library):
    docs = documents(spark, sf_dir)
    rows = mixture.mixture_digest(docs, FILE).collect()
    spans = check(rows, [(r.doc_id, r.text) for r in docs.collect()], library)
    total = sum(r.length for r in rows)
    assert len(spans) <= total // 1024 + 10
    # Every source with a queue of its own has its share of every sequence, to one token.
    tokens = Counter()
    for r in rows:
        tokens[r.source] += r.length
    own = {s for s, n in tokens.items() if n * 1024 >= 16 * total}
    for sequence in list(spans)[:200]:
        length = sum(n for _, n in spans[sequence])
        counts = Counter()
        for r in rows:
            if r.sequence_id == sequence:
                counts[r.source] += r.length
        for source in own:
            assert abs(counts[source] - length * tokens[source] / total) < 2


def test_targets(spark, sf_dir, library):
    docs = documents(spark, sf_dir)
    sources = sorted({r.source for r in docs.select("source").collect()})
    rows = mixture.mixed_sequences(docs, FILE, targets={sources[0]: 3, sources[1]: 1}, size=64).collect()
    counts = defaultdict(Counter)
    for r in rows:
        counts[r.sequence_id][r.source] += r.length
    assert counts[0] == {sources[0]: 48, sources[1]: 16}
    assert sum(r.length for r in rows) == sum(len(ids_of(library, r.text)) for r in docs.collect())
    for r in rows:
        assert len(r.ids) == 4 * r.length


def test_many_tasks_and_long_texts(spark, library):
    data = [(i, "hot" if i % 3 else f"s{i % 40}", f"number {i} " * (i % 50) if i % 7 else None) for i in range(600)] + [(1000, None, "word " * 30000)]
    docs = spark.createDataFrame(data, "doc_id long, source string, text string").repartition(13)
    rows = mixture.mixture_digest(docs, FILE).collect()
    check(rows, [(i, t) for i, _, t in data], library)


def test_awkward_rows(spark, awkward, no_docs, library):
    from pyspark.sql import functions as F

    with_source = awkward.withColumn("source", F.when(F.col("row") % 2 == 0, F.lit("a"))).withColumn("part", F.lit("x")).withColumn("queue", F.lit(0)).withColumn("ids", F.lit(1))
    rows = mixture.mixture_digest(with_source, FILE).collect()
    check(rows, [(r.doc_id, r.text) for r in awkward.collect()], library)
    assert mixture.mixture_digest(no_docs.withColumn("source", F.lit("a")), FILE).count() == 0
