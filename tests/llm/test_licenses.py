from __future__ import annotations

import re

import duckdb
import pytest

from oreworks.llm import licenses

from ..oracle_compare import connect, duck_rows, spark_rows
from .conftest import documents


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def kept(block):
    """By hand: (label, share) of a block's templates, but for those whose words are within a better one's."""
    have, pairs = set(block), set(zip(block, block[1:]))
    held = []
    for label, template in licenses.TEMPLATES:
        t = words(template)
        own, near = set(t), set(zip(t, t[1:]))
        share, order = len(own & have) / len(own), len(near & pairs) / len(near)
        if share == order == 1 or (len(own) > licenses.SHORT and share >= 0.8 - 1e-9 and order >= 0.5 - 1e-9):
            held.append((share, own & have, label))
    return [(lab, c) for c, own, lab in held if not any(own <= o and (d, len(o)) > (c, len(own)) for d, o, _ in held)]


def scan(text):
    """By hand: phrases at every place, every template in every block."""
    w = words(text)
    places, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        places += at
        if at:
            base.add(label)
    more, best = set(), 0.0
    for start in range(0, max(len(w) - 33, 0) + 1, 32):
        found = kept(w[start : start + 64])
        more |= {label for label, _ in found}
        best = max([best, *(share for _, share in found)])
    first, last = (min(places), max(places)) if places else (None, None)
    return len(w), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if places else best


def rows_of(df):
    return sorted(((r.doc_id, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)) for r in df.collect()), key=repr)


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"

TEXTS = [
    "Released under the MIT License.",
    "MIT/LICENSE mit-license, the MIT, license",
    "General  Public\nLicense and general public license",
    "apache licence", "APACHE LICENSE", "mıt lıcense mitlicense",
    "filler " * 100 + MIT + " filler" * 70,
    MIT.replace("free of charge", "without cost"),
    " ".join(MIT.split()[:9]),
    "Licensed under CC BY-SA 4.0.", "Licensed under CC BY-NC 4.0.", "under CC BY 4.0",
    "über öffentliche license general public", None, "", " ", "0", "license",
    "word " * 33, "word " * 34 + "Released under the MIT License", "word " * 70,
]


def test_fixture_against_brute_force(spark):
    docs = spark.createDataFrame([(i, t, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, words string, starts int")
    assert rows_of(licenses.license_scan(docs)) == sorted(((i, scan(t)) for i, t in enumerate(TEXTS)), key=repr)


def test_whole_table_against_sql(spark, sf_dir):
    docs = documents(spark, sf_dir)
    sql = duck_rows(connect(sf_dir), licenses.oracle_sql())
    assert spark_rows(licenses.license_scan(docs)) == sql
    assert any(r.n_base for r in licenses.license_scan(docs).collect())


@pytest.mark.parametrize("threshold", [0.5, 1.0])
def test_filters_lose_nothing(spark, threshold):
    """Prefix, length and position filters against plain containment, at other thresholds."""
    templates = [("a", "one two three four five six"), ("b", "six five seven"), ("c", "nine")]
    texts = ["one two three", "four five six one", "six seven", "five seven six nine", "one one one six", "nine", "none"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.score for r in licenses.license_scan(docs, templates, threshold, 0, 0.0).collect()}
    for i, text in enumerate(texts):
        shares = [len(set(t.split()) & set(text.split())) / len(t.split()) for _, t in templates]
        assert got[i] == pytest.approx(max([s for s in shares if s >= threshold], default=0.0))


def test_awkward_rows(awkward, no_docs):
    rows = licenses.license_scan(awkward).collect()
    assert len(rows) == 12
    assert all((r.n_words, r.n_base, r.labels, r.score) == (0, 0, "", 0.0) for r in rows if r.doc_id in (2, 3, 4))
    assert next(r.n_words for r in rows if r.doc_id == 7) == 6000
    assert licenses.license_scan(no_docs).count() == 0


APACHE = "you may not use this file except in compliance with the License You may obtain a copy of the License at"
LGPL = "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"


def test_two_notices_in_one_block(spark):
    """A notice with a word changed counts beside a whole one; relatives that only share its words do not."""
    texts = [
        f"{MIT} or {APACHE.replace('compliance', 'accordance')}",
        f"{MIT} or {APACHE}",
        LGPL.replace("Lesser ", ""),
        LGPL.replace("Lesser ", "") + " Licensed under CC BY-NC 4.0",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.license_scan(docs).collect()}
    assert got == {0: {"mit", "apache"}, 1: {"mit", "apache"}, 2: {"gpl"}, 3: {"gpl", "cc-by-nc"}}


def test_every_match_but_contained_ones_against_brute_force(spark, sf_dir):
    docs = documents(spark, sf_dir)
    got = {r.doc_id: set(filter(None, r.labels.split(","))) for r in licenses.license_scan(docs).collect()}
    for r in docs.collect():
        w = words(r.text)
        want = {label for p, label in licenses.PHRASES.items() if f" {p} " in f" {' '.join(w)} "}
        for start in range(0, max(len(w) - 33, 0) + 1, 32):
            want |= {label for label, _ in kept(w[start : start + 64])}
        assert got[r.doc_id] == want


SHUFFLED = " ".join(sorted(MIT.split()))

WORDING = {
    "the license was released under pressure": "",
    "no license; it was released for the MIT press": "",
    "no license, it was released under the MIT press": "",
    "Released under the BSD License": "bsd",
    "Released under the Apache License": "apache",
    "Licensed under CC BY 4.0": "cc-by",
    "Licensed under CC BY-NC-SA 4.0": "cc-by-nc-sa",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa",
    SHUFFLED: "",
    MIT.replace("free of charge", "at no cost"): "mit",
    LGPL: "gpl,lgpl",
}


def test_order_and_deciding_words(spark):
    """The words of a notice in another order, or without the one that decides, are no notice."""
    docs = spark.createDataFrame(list(enumerate(WORDING)), "doc_id long, text string")
    got = {r.doc_id: r.labels for r in licenses.license_scan(docs).collect()}
    assert got == dict(enumerate(WORDING.values()))


def test_planted_notices_against_sql(spark, tmp_path):
    """Fixture and wording, far from each other and within one block, by the query's SQL."""
    texts = [*TEXTS, *WORDING, f"{MIT} or {APACHE}", f"{APACHE.replace('compliance', 'accordance')} {MIT}", "x " * 200 + LGPL + " y" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as from '{tmp_path}/documents.parquet/*.parquet'")
    assert spark_rows(licenses.license_scan(docs)) == duck_rows(con, licenses.oracle_sql())
