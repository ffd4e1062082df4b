"""Licence passages by an exact set-similarity join (built-in functions only).

Base places are found on the normalised word string.  The join compares every window of ceil(words of the template /
CONTAINMENT) consecutive words, wherever lines break, with the template as a word set: a window matches when it
holds at least ``CONTAINMENT`` of its words and, in a short template, the word that names the licence.

Windows are looked for in blocks: one starts every ``STEP`` words (the longest window) and has twice as many, so
each window lies whole in a block and the filters on blocks lose none.

* Words are ordered by how many documents of the whole corpus have them, rarest first.
* Prefix filter: a block that holds a = ceil(CONTAINMENT * |T|) words of T holds one of T's |T| - a + 1 rarest.
* Length filter: a block has at least a words that occur in templates.
* Positional filter: from the first shared word on, both ordered lists must still have a - 1 words.
* What is left is verified on each window of the block, so the filters lose nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardline.llm.common import docs_of, stage

CONTAINMENT = 0.8
#: Phrases that count as base places, and their labels (fixed values).
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
#: Template sentences of well-known licences (fixed values): label, words.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
            "that the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
            "associated documentation files"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
#: Words without which a short template says nothing of its licence ("released under the new license").
NAMES = {"licensed under the apache license version 2 0": "apache",
         "this work is licensed under the gnu general public license version 3": "gnu",
         "released under the mit license": "mit"}
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def spaced(text: Column) -> Column:
    """The words of a text, lower-cased in ASCII, each between single spaces; a text without words is one space."""
    return F.regexp_replace(F.concat(F.lit(" "), F.translate(text, _UPPER, _LOWER), F.lit(" ")), _NOT_WORD, " ")


def _spaces(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _base(d: DataFrame) -> DataFrame:
    """n_words, the number of places of each phrase and their first and last word, from ``spaced``."""
    d = d.withColumn("n_words", (_spaces(F.col("spaced")) - 1).cast("long"))
    for i, (phrase, _) in enumerate(PHRASES):
        found = F.contains("spaced", F.lit(f" {phrase} "))
        d = d.withColumn(f"_parts{i}", F.when(found, F.split("spaced", f"(?<= ){phrase}(?= )", -1)))
        d = d.withColumns({
            f"_n{i}": F.coalesce(F.size(f"_parts{i}") - 1, F.lit(0)).cast("long"),
            f"_first{i}": (_spaces(F.element_at(f"_parts{i}", 1)) - 1).cast("long"),
            f"_last{i}": (F.col("n_words") - _spaces(F.element_at(f"_parts{i}", -1)) + 1 - len(phrase.split())).cast("long")})
        d = d.withColumn(f"_n{i}", F.when(found, F.col(f"_n{i}")).otherwise(F.lit(0)))
    every = range(len(PHRASES))
    labels = F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(F.col(f"_n{i}") > 0, F.lit(PHRASES[i][1])) for i in every]),
                                                    lambda x: x.isNotNull())))
    return d.select("doc_id", "row", "spaced", "n_words", sum((F.col(f"_n{i}") for i in every), F.lit(0)).cast("long").alias("n_base"),
                    F.least(*[F.col(f"_first{i}") for i in every]).alias("first_word"),
                    F.greatest(*[F.col(f"_last{i}") for i in every]).alias("last_word"), labels.alias("base"))


def word_order(hits: DataFrame) -> list[str]:
    """The template words, rarest in the corpus first (ties by the word itself)."""
    vocabulary = sorted({w for _, t in TEMPLATES for w in t.split()})
    seen = {r[0]: r[1] for r in hits.select(F.explode("words").alias("w")).groupBy("w").count().collect()}  # template words only
    return sorted(vocabulary, key=lambda w: (seen.get(w, 0), w))


def similar_blocks(docs: DataFrame, order: list[str], containment: float = CONTAINMENT) -> DataFrame:
    """(row, label, score): the best containment of each label's templates in any window of a text (row, text)."""
    spark = docs.sparkSession
    rank = {w: i + 1 for i, w in enumerate(order)}
    sets = [(k, label, sorted(rank[w] for w in set(t.split())), math.ceil(len(t.split()) / containment), rank.get(NAMES.get(t), 0))
            for k, (label, t) in enumerate(TEMPLATES)]
    step = max(w for *_, w, _ in sets)
    prefix = [(r, k, label, i, len(s), math.ceil(containment * len(s)), w, name, s) for k, label, s, w, name in sets
              for i, r in enumerate(s[:len(s) - math.ceil(containment * len(s)) + 1])]
    t = spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"({r}, {k}, '{label}', {i}, {n}, {a}, {w}, {name}, array({', '.join(map(str, s))}))" for r, k, label, i, n, a, w, name, s in prefix)
        + " AS t(rank, template, label, t_at, t_size, need, width, name, t_set)")
    rare = _strings(sorted({order[r[0] - 1] for r in prefix}))
    blocks = docs.select("row", F.split(F.trim(spaced(F.col("text"))), " ").alias("words")).where(F.arrays_overlap("words", rare))
    blocks = blocks.select("row", F.explode(F.transform(
        F.sequence(F.lit(0), F.floor((F.size("words") - 1) / step).cast("int")),
        lambda i: F.slice("words", i * step + 1, 2 * step))).alias("words")).where(F.arrays_overlap("words", rare))
    in_block = F.array_sort(F.transform(F.array_intersect("words", _strings(order)), lambda w: F.array_position(_strings(order), w).cast("int")))
    blocks = blocks.select("row", "words", in_block.alias("b_set"))
    pairs = blocks.select("row", "words", "b_set", F.posexplode("b_set").alias("b_at", "rank")) \
        .join(F.broadcast(t), "rank") \
        .where((F.size("b_set") >= F.col("need"))
               & (F.least(F.col("t_size") - F.col("t_at"), F.size("b_set") - F.col("b_at")) >= F.col("need"))) \
        .where((F.size(F.array_intersect("b_set", "t_set")) >= F.col("need")) & ((F.col("name") == 0) | F.array_contains("b_set", F.col("name"))))
    # the ranks of the block in the order of its words, 0 for other words
    ranks = pairs.select("row", "label", "t_set", "t_size", "need", "width", "name",
                         F.transform("words", lambda w: F.array_position(_strings(order), w).cast("int")).alias("ranks"))
    def shared(i):
        window = F.slice("ranks", i, F.col("width"))
        return F.when((F.col("name") == 0) | F.array_contains(window, F.col("name")), F.size(F.array_intersect(window, "t_set"))).otherwise(0)
    # a pair may pass on several shared words; verifying each gives the same answer, so none needs a shuffle to go
    pairs = ranks.withColumn("shared", F.array_max(F.transform(
        F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("ranks") - F.col("width") + 1)), shared))).where("shared >= need")
    return pairs.groupBy("row", "label").agg(F.max(F.col("shared") / F.col("t_size")).alias("score"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    A null or empty text has no words, no labels (empty strings) and score 0.  The score is 1 with a base place,
    else the best containment of a matching window, else 0.  Texts are named by a 64-bit hash of id and text, so null
    and repeated ids are no matter.
    """
    d = docs_of(docs, id_col, text_col).withColumn("row", F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text"))
    vocabulary = sorted({w for _, t in TEMPLATES for w in t.split()})
    base = _base(d.select("doc_id", "row", spaced(F.col("text")).alias("spaced")))
    base = stage(base.withColumn("words", F.array_intersect(F.split("spaced", " "), _strings(vocabulary))).drop("spaced"), "licence-base")
    hits = similar_blocks(d.select("row", "text"), word_order(base), containment)
    hits = hits.groupBy("row").agg(F.collect_set("label").alias("found"), F.max("score").alias("best"))
    empty = F.array().cast("array<string>")
    return base.join(hits, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.concat_ws(",", "base").alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("base", F.coalesce("found", empty)))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))


def oracle(containment: float = CONTAINMENT) -> str:
    """The same rows in DuckDB SQL: places by list positions, every block against every template."""
    templates = ", ".join(f"('{label}', list_distinct(string_split('{t}', ' ')))" for label, t in TEMPLATES)
    def places(phrase):
        return " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase.split(), 1))
    words = "regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    at = ", ".join(f"[i for i in range(0, len(w)) if {places(p)}] AS p{k}" for k, (p, _) in enumerate(PHRASES))
    base = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, (_, label) in enumerate(PHRASES))
    every = ", ".join(f"p{k}" for k in range(len(PHRASES)))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, coalesce(text, '') AS text FROM documents),
t(label, words) AS (VALUES {templates}),
w AS (SELECT rn, doc_id, {words.format('text')} AS w FROM d),
p AS (SELECT rn, doc_id, len(w) AS n_words, {at} FROM w),
b AS (SELECT rn, doc_id, n_words, flatten([{every}]) AS places, list_filter([{base}], lambda x: x IS NOT NULL) AS base FROM p),
lines AS (SELECT rn, unnest(string_split(text, chr(10))) AS line FROM d),
sets AS (SELECT rn, list_distinct({words.format('line')}) AS s FROM lines),
m AS (SELECT rn, label, len(list_intersect(s, words)) / len(words) AS score FROM sets, t
      WHERE len(list_intersect(s, words)) >= ceil({containment} * len(words))),
g AS (SELECT rn, list(DISTINCT label) AS found, max(score) AS best FROM m GROUP BY rn)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       array_to_string(list_sort(list_distinct(base)), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(base, coalesce(found, [])))), ',') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0)::DOUBLE END AS score
FROM b LEFT JOIN g USING (rn)
"""
