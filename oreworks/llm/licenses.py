"""License scans: an exact set-similarity join of text blocks with license templates, and base phrases.

A block holds a template if it has at least THRESHOLD of the template's distinct words. All
template words are ordered by how often they stand in the corpus, rarest first. A
block that holds a template shares one of the first |T| - need + 1 words of it
(prefix filter), has ``need`` distinct words itself (length filter), and what is left of the
template from its first shared word on suffices (positional filter). What passes is counted exactly,
and must then show the template's order: enough of its pairs of neighbouring words, or all words and
pairs of a short notice. Built-in functions only.
"""

from __future__ import annotations

import re
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreworks.llm.common import ascii_lower, written

WORD_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
THRESHOLD = 0.8
# Blocks are runs of this many words, every half of it, so that every run of half a block lies in one.
BLOCK = 64
# Notices of at most so many distinct words count only as they are: all words, all pairs of neighbours.
SHORT = 10
# Share of a longer template's pairs of neighbours that must stand too: a fifth of its words changed costs two fifths at most.
ORDERED = 0.5
# Words and pairs of a template are bits of a long.
MOST_WORDS = 63

# Base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Sentences of public licenses, with labels.
SENTENCES = [
    ("agpl", "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache", "you may not use this file except in compliance with the License You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("zlib", "In no event will the authors be held liable for any damages arising from the use of this software"),
]

# Names in notices "under the .. License", and variants of "CC .. 4.0".
NAMES = {
    "agpl": "GNU Affero General Public",
    "apache": "Apache",
    "bsd": "BSD",
    "gpl": "GNU General Public",
    "isc": "ISC",
    "lgpl": "GNU Lesser General Public",
    "mit": "MIT",
    "mpl": "Mozilla Public",
}
VARIANTS = ["BY", "BY-NC", "BY-NC-ND", "BY-NC-SA", "BY-ND", "BY-SA"]

TEMPLATES = [
    *SENTENCES,
    *((label, f"under the {name} License") for label, name in NAMES.items()),
    *((f"cc-{variant.lower()}", f"CC {variant} 4.0") for variant in VARIANTS),
]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_GAPS), "")


def _sequence(text: str) -> list[str]:
    """A template's words, split as texts are."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return [w for w in re.split(WORD_GAPS, low) if w]


def _pairs(text: str) -> list[tuple[str, str]]:
    """Distinct pairs of neighbouring words."""
    words = _sequence(text)
    return list(dict.fromkeys(zip(words, words[1:])))


def _template_rows(templates: list[tuple[str, str]]) -> list[tuple[int, str, str]]:
    """(template, label, word) of distinct words."""
    return [(i, label, word) for i, (label, text) in enumerate(templates) for word in dict.fromkeys(_sequence(text))]


def _needs(n_words: int, n_pairs: int, threshold: float, short: int, ordered: float) -> tuple[int, int]:
    """Words and pairs of neighbours that a block must hold."""
    if n_words <= short:
        return n_words, n_pairs
    return ceil(n_words * threshold - 1e-9), ceil(n_pairs * ordered - 1e-9)


# A word of a template: its place by rarity, and the bit of each pair that it begins.
ORDERED_WORDS = """template int, label string, word string, place int, size int, need int,
                   need_pairs int, nexts map<string, long>"""


def _ordered_templates(
    words: DataFrame, templates: list[tuple[str, str]], threshold: float, short: int, ordered: float
) -> list[tuple]:
    """Rows of ORDERED_WORDS with places by corpus frequency, rarest first, then by word.

    The frequencies are those of template words over all texts: a few hundred rows at most.
    """
    spark = words.sparkSession
    rows = _template_rows(templates)
    vocabulary = spark.createDataFrame(sorted({(w,) for _, _, w in rows}), "word string")
    counts = dict(
        words.select(F.explode("words").alias("word")).join(F.broadcast(vocabulary), "word").groupBy("word").count().collect()
    )
    out = []
    for i, (_, text) in enumerate(templates):
        own = sorted((counts.get(w, 0), w, label) for t, label, w in rows if t == i)
        pairs = _pairs(text)
        if max(len(own), len(pairs)) > MOST_WORDS:
            raise ValueError(f"a template has at most {MOST_WORDS} distinct words and pairs: {text}")
        need, need_pairs = _needs(len(own), len(pairs), threshold, short, ordered)
        for place, (_, w, label) in enumerate(own):
            nexts = {b: 1 << k for k, (a, b) in enumerate(pairs) if a == w}
            out.append((i, label, w, place, len(own), need, need_pairs, nexts))
    return out


def _starts(words: Column, phrase: str) -> Column:
    """Places where the phrase's words stand consecutively."""
    parts = phrase.split()
    n = F.size(words)
    at = lambda i: _all([F.get(words, i + k) == F.lit(p) for k, p in enumerate(parts)])
    return F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.coalesce(at(i), F.lit(False)))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _blocks(n_words: Column) -> Column:
    """First words of the blocks of a text; a text of at most one block has one."""
    return F.sequence(F.lit(0), F.greatest(n_words - BLOCK + BLOCK // 2 - 1, F.lit(0)), F.lit(BLOCK // 2))


def _literals(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def block_matches(candidates: DataFrame, ordered: list[tuple]) -> DataFrame:
    """(row, words) -> (row, block, label, containment) of every block and template that meet the threshold in order.

    A template is left out only if its words found in the block are among those of a template of higher containment, or of
    one of equal containment with more words, so that a notice is not taken for its relatives, and two notices that stand
    close together both count.
    """
    spark = candidates.sparkSession
    table = spark.createDataFrame(ordered, ORDERED_WORDS)
    by_template = {}
    for template, label, word, _, size, need, need_pairs, _ in ordered:
        by_template.setdefault(template, (template, label, size, need, need_pairs, []))[-1].append(word)
    heads = spark.createDataFrame(
        list(by_template.values()),
        "template int, label string, size int, need int, need_pairs int, template_words array<string>",
    )
    blocks = candidates.select("row", "words", F.explode(_blocks(F.size("words"))).alias("block")).select(
        "row",
        "block",
        F.slice("words", F.col("block") + 1, BLOCK).alias("word"),
        F.slice("words", F.col("block") + 2, BLOCK - 1).alias("next"),
    )
    tokens = blocks.select(
        "row", "block", F.size(F.array_distinct("word")).alias("n"), F.explode(F.arrays_zip("word", "next")).alias("t")
    ).select("row", "block", "n", "t.word", "t.next")
    # The templates are a fixed list, so both broadcasts are bounded.
    shared = tokens.join(F.broadcast(table), "word").where("n >= need")
    found = (
        shared.groupBy("row", "block", "template")
        .agg(
            F.min("place").alias("first"),
            F.bit_or(F.expr("shiftleft(1L, place)")).alias("shared"),
            F.bit_or(F.expr("coalesce(try_element_at(nexts, next), 0L)")).alias("pairs"),
        )
        .join(F.broadcast(heads), "template")
        .where("first <= size - need and bit_count(shared) >= need and bit_count(pairs) >= need_pairs")
        .select(
            "row",
            "block",
            "label",
            (F.bit_count("shared") / F.col("size")).alias("containment"),
            F.expr("filter(template_words, (w, i) -> getbit(shared, i) = 1)").alias("shared"),
        )
    )
    # A block meets at most as many templates as there are.
    held = found.groupBy("row", "block").agg(F.collect_list(F.struct("label", "containment", "shared")).alias("held"))
    better = lambda t: F.exists(
        "held",
        lambda o: (
            (o["containment"] > t["containment"])
            | ((o["containment"] == t["containment"]) & (F.size(o["shared"]) > F.size(t["shared"])))
        )
        & (F.size(F.array_except(t["shared"], o["shared"])) == 0),
    )
    return held.select("row", "block", F.explode(F.filter("held", lambda t: ~better(t))).alias("t")).select(
        "row", "block", "t.label", "t.containment"
    )


def license_scan(
    docs: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    short: int = SHORT,
    ordered: float = ORDERED,
) -> DataFrame:
    """(doc_id, text, ..) -> doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; one row per row.

    score: 1 where a base phrase stands, else the highest containment of a template found, else 0. Templates of at most ``short``
    distinct words need all their words and pairs of neighbours, others ``threshold`` of the words and ``ordered`` of the pairs.
    NULL and empty texts have no words, no labels and score 0; very long ones are read whole, block by block; repeated rows and
    ids are rows of their own; an empty table gives an empty one. Texts without any prefix word of a template or base phrase
    never leave the first scan.
    """
    words = docs.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words")
    )
    table = _ordered_templates(words, templates, threshold, short, ordered)
    prefix = sorted({w for _, _, w, place, size, need, _, _ in table if place <= size - need})
    bases = sorted({p.split()[-1] for p in PHRASES})
    starts = F.array_sort(F.flatten(F.array(*[_starts(F.col("words"), p) for p in PHRASES])))
    labels = F.array(
        *[F.when(F.size(_starts(F.col("words"), p)) > 0, F.lit(label)) for p, label in PHRASES.items()]
    )
    may_hold_base = F.arrays_overlap("words", _literals(bases))
    rows = words.select(
        "row",
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.when(may_hold_base, starts).alias("starts"),
        F.when(may_hold_base, F.array_compact(labels)).alias("base"),
        F.when(F.arrays_overlap("words", _literals(prefix)), F.col("words")).alias("words"),
    )
    rows = written(rows, "license_rows")
    found = block_matches(rows.where("words is not null").select("row", "words"), table)
    of_row = found.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("containment"))
    none = F.array().cast("array<string>")
    base = F.array_sort(F.array_distinct(F.coalesce("base", none)))
    every = F.array_sort(F.array_union(F.coalesce("base", none), F.coalesce("more", none)))
    n_base = F.coalesce(F.size("starts"), F.lit(0))
    return (
        rows.drop("words")
        .join(of_row, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.when(F.col("starts").isNull(), 0).otherwise(n_base).cast("long").alias("n_base"),
            F.get("starts", F.lit(0)).cast("long").alias("first_word"),
            F.get("starts", F.size("starts") - 1).cast("long").alias("last_word"),
            F.array_join(base, ",").alias("base_labels"),
            F.array_join(every, ",").alias("labels"),
            F.when(F.size("starts") > 0, 1.0).otherwise(F.coalesce("containment", F.lit(0.0))).alias("score"),
        )
    )


def oracle_sql(templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> str:
    """The same rows by brute force over every block and template."""
    rows = []
    for label, text in templates:
        words, pairs = list(dict.fromkeys(_sequence(text))), [f"{a} {b}" for a, b in _pairs(text)]
        need, need_pairs = _needs(len(words), len(pairs), threshold, SHORT, ORDERED)
        rows.append(f"('{label}', {words}, {pairs}, {len(words)}, {need}, {need_pairs})")
    values = ", ".join(rows)
    phrases = ", ".join(
        f"('{label}', '{p.split()[0]}', '{p.split()[1]}', {repr(p.split()[2]) if len(p.split()) > 2 else 'null'})"
        for p, label in PHRASES.items()
    )
    return rf"""
with low as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), tpl as (
  select * from (values {values}) as v(label, words, pairs, size, need, need_pairs)
), phr as (
  select * from (values {phrases}) as v(label, a, b, c)
), base as (
  select doc_id, label, i - 1 as place
  from (select doc_id, w, unnest(range(1, len(w) + 1)) as i from low), phr
  where w[i] = a and w[i + 1] = b and (c is null or w[i + 2] = c)
), base_of as (
  select doc_id, count(*) as n, min(place) as lo, max(place) as hi, list_sort(list(distinct label)) as labels
  from base group by doc_id
), blocks as (
  select doc_id, b, list_distinct(q) as s, list_distinct([q[i] || ' ' || q[i + 1] for i in range(1, len(q))]) as p
  from (
    select doc_id, b, w[b + 1 : b + {BLOCK}] as q
    from (select doc_id, w, unnest(range(0, greatest(len(w) - {BLOCK // 2 + 1}, 0) + 1, {BLOCK // 2})) as b from low)
  )
), held as (
  select doc_id, b, label, list_intersect(s, words) as shared, len(list_intersect(s, words)) / size as containment
  from blocks, tpl where len(list_intersect(s, words)) >= need and len(list_intersect(p, pairs)) >= need_pairs
), best as (
  select h.doc_id, h.label, h.containment from held h
  where not exists (
    from held o where o.doc_id = h.doc_id and o.b = h.b
      and (o.containment > h.containment or (o.containment = h.containment and len(o.shared) > len(h.shared)))
      and len(list_intersect(h.shared, o.shared)) = len(h.shared)
  )
), found as (
  select doc_id, list(distinct label) as labels, max(containment) as containment from best group by doc_id
)
select l.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_base,
       cast(lo as bigint) as first_word, cast(hi as bigint) as last_word,
       coalesce(array_to_string(o.labels, ','), '') as base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(o.labels, []), coalesce(f.labels, [])))), ','), '') as labels,
       case when n > 0 then 1.0::double else coalesce(f.containment, 0)::double end as score
from low l left join base_of o using (doc_id) left join found f using (doc_id)
"""
