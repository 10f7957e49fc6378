r"""License scan: an exact set-similarity join of text blocks with license templates, DataFrame functions only.

Words are what stands between ``SEPARATOR`` runs after A-Z are lower-cased.  A text's
blocks are its windows of ``2 * STRIDE`` words, one every ``STRIDE`` words,
so every stretch of ``STRIDE`` words (no template is longer) lies whole in
one block.  A block meets a template when it holds at least ``THRESHOLD``
per cent of the template's distinct words (containment of the template).

1. ``digest``: one scan of the texts gives the base columns and, per block,
   its distinct words that occur in any template (other words cannot count).
   Length filter: a block with fewer of them than the least overlap any
   template asks for is dropped there.  Written once, with a row number.
2. The template words are counted over all those blocks.  The counts, at
   most one row per template word, give the global order, rarest first.
3. Blocks and templates become sorted lists of ranks.  A template of m words
   that needs an overlap of o can only meet a block that shares one of the
   template's first m - o + 1 words within the block's own first b - o + 1
   (prefix filter), has b >= o words (length filter), and where the shared
   word leaves enough words behind it in both lists (positional filter).
   The template prefixes are a broadcast table bounded by the templates.
4. Candidates are verified by the exact overlap; ``find_blocks`` returns
   them, ``scan`` groups them per document.

Hot words do no harm: a block joins a bounded table of prefixes, and
nothing is grouped by word but a count with partial sums.

Base: places where the words of a phrase of ``PHRASES`` stand in a row.
They are found in the words joined by double spaces, each word between
single ones, so neighbouring places share no character.

Defined results: a null or empty text has no words, no places, empty labels
and score 0.  The score is 1 where a base phrase stands, else the largest
containment of a template met, else 0.  Rows are judged one by one (repeated
rows repeat, ids may be null); an empty table gives an empty result; only
the id and text columns are read, so other columns cannot clash.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.operators.materialize import materialize

#: Fixed values of the contract.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

STRIDE = 64
THRESHOLD = 80
#: (label, wording of a public license's notice or its best known sentence), at most STRIDE words each.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the Software), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "The software is provided as is, without warranty of any kind, express or implied, including but not limited to "
            "the warranties of merchantability, fitness for a particular purpose and noninfringement"),
    ("apache", "You may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an as is basis, without warranties or conditions of any kind, either express or implied"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License as published by the Free Software Foundation"),
    ("agpl", "It is distributed under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
            "products derived from this software without specific prior written permission"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
            "not distributed with this file, you can obtain one"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "You are free to share, copy and redistribute the material in any medium or format and to adapt, remix, "
              "transform and build upon the material as long as you give appropriate credit"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
                  "publish, use, compile, sell, or distribute this software"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced, stored in a retrieval system or "
                    "transmitted in any form or by any means without the prior written permission of the publisher"),
)


def template_words(text: str) -> list[str]:
    """The distinct words of a template, in order of first place."""
    found = [w for w in re.split(SEPARATOR, text.translate(str.maketrans(UPPER, LOWER))) if w]
    if len(found) > STRIDE:
        raise ValueError(f"a template has {len(found)} words, more than {STRIDE}")
    return list(dict.fromkeys(found))


def needed(size: int, threshold: int) -> int:
    """The least overlap o with 100 * o >= threshold * size."""
    return max(1, -(-threshold * size // 100))


def _spaced(phrase: str) -> str:
    return "".join(f" {w} " for w in phrase.split())


def _count_words(spaced: Column) -> Column:
    """Words of a text in which every word stands between single spaces."""
    return ((F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("long")


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: int = THRESHOLD) -> DataFrame:
    """Per row: ``row``, id, n_words, n_base, first_word, last_word, base (labels), blocks (at, words), kept as a table."""
    sets = [template_words(t) for _, t in templates]
    least = min((needed(len(s), threshold) for s in sets), default=1)
    vocabulary = F.array(*[F.lit(w) for w in sorted(set().union(*sets))]).cast("array<string>")
    lowered = F.translate(F.coalesce(F.col(text_col).cast("string"), F.lit("")), UPPER, LOWER)
    joined = F.trim(F.regexp_replace(lowered, SEPARATOR, "  "))
    a = docs.select(F.col(id_col).alias("id"), F.when(joined == "", F.lit("")).otherwise(F.concat(F.lit(" "), joined, F.lit(" "))).alias("spaced"))
    spaced = F.col("spaced")
    n_words = _count_words(spaced)
    hits = []
    for phrase, label in PHRASES.items():
        p = F.lit(_spaced(phrase))
        hits.append(F.when(F.contains(spaced, p), F.struct(
            F.lit(label).alias("label"),
            ((F.length(spaced) - F.length(F.replace(spaced, p, F.lit("")))) / len(_spaced(phrase))).cast("long").alias("n"),
            _count_words(F.substring_index(spaced, _spaced(phrase), 1)).alias("first"),
            (n_words - _count_words(F.substring_index(spaced, _spaced(phrase), -1)) - len(phrase.split())).alias("last"))))
    b = a.select("id", spaced, n_words.alias("n_words"), F.array_compact(F.array(*hits)).alias("hits"))
    words = F.split(F.trim("spaced"), "  ", -1)
    c = b.select("id", "n_words", "hits", F.when(F.col("n_words") > 0, words).alias("words"))
    n = F.col("n_words").cast("int")
    starts = F.sequence(F.lit(0), F.greatest(n - STRIDE - 1, F.lit(0)), F.lit(STRIDE))
    blocks = F.transform(starts, lambda i: F.struct(
        i.alias("at"), F.array_intersect(F.slice(F.col("words"), i + 1, F.lit(2 * STRIDE)), vocabulary).alias("words")))
    rows = c.select(
        F.monotonically_increasing_id().alias("row"), "id", "n_words",
        F.aggregate("hits", F.lit(0).cast("long"), lambda acc, x: acc + x["n"]).alias("n_base"),
        F.array_min(F.transform("hits", lambda x: x["first"])).alias("first_word"),
        F.array_max(F.transform("hits", lambda x: x["last"])).alias("last_word"),
        F.transform("hits", lambda x: x["label"]).alias("base"),
        F.when(F.col("words").isNotNull(), F.filter(blocks, lambda x: F.size(x["words"]) >= least)).alias("blocks"))
    return materialize(rows, "license-digest")  # the stored row number is the same for every reader


def word_order(kept: DataFrame, templates=TEMPLATES) -> list[str]:
    """All template words, those in the fewest blocks first, ties by the word; one row per template word is collected."""
    found = kept.select(F.explode("blocks.words").alias("words")).select(F.explode("words").alias("word")).groupBy("word").count()
    count = {r[0]: r[1] for r in found.collect()}
    return sorted(set().union(*[template_words(t) for _, t in templates]), key=lambda w: (count.get(w, 0), w))


def find_blocks(kept: DataFrame, templates=TEMPLATES, threshold: int = THRESHOLD) -> DataFrame:
    """Every (block, template) whose containment reaches ``threshold``: row, id, at, n_block_words, template, label, overlap, score.

    ``kept`` is a ``digest`` made with the same templates and threshold; ``at`` is the block's first word.
    """
    order = word_order(kept, templates)
    rank = {w: i for i, w in enumerate(order)}
    prefixes, full = [], []
    for number, (label, text) in enumerate(templates):
        ranks = sorted(rank[w] for w in template_words(text))
        o = needed(len(ranks), threshold)
        prefixes += [(r, number, at, len(ranks), o) for at, r in enumerate(ranks[:len(ranks) - o + 1])]
        full.append((number, label, ranks))
    spark = kept.sparkSession
    index = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, prefixes))} AS p(p_rank, template, p_at, p_size, need)").join(F.broadcast(
        spark.sql(f"SELECT * FROM VALUES {', '.join(f'({n}, {label!r}, array{tuple(r)})' for n, label, r in full)} AS t(template, label, ranks)")),
        "template")
    least = min(p[4] for p in prefixes)
    ranked = F.array(*[F.lit(w) for w in order])
    blocks = kept.select("row", "id", "n_words", F.explode("blocks").alias("b")).select(
        "row", "id", F.col("b.at").alias("at"), F.least(F.lit(2 * STRIDE), F.col("n_words") - F.col("b.at")).alias("n_block_words"),
        F.array_sort(F.transform("b.words", lambda w: (F.array_position(ranked, w) - 1).cast("int"))).alias("block"))
    size = F.size("block")
    probes = blocks.select("*", F.posexplode(F.slice("block", F.lit(1), size - least + 1)).alias("b_at", "b_rank"))
    overlap = F.size(F.array_intersect("block", "ranks"))
    # Several shared prefix words find one pair; only the first of them in the block's order verifies it.
    first = F.col("b_rank") == F.array_min(F.array_intersect("block", F.slice("ranks", F.lit(1), F.col("p_size") - F.col("need") + 1)))
    near = probes.join(F.broadcast(index), F.col("b_rank") == F.col("p_rank")).where(
        (size >= F.col("need"))  # length
        & (F.least(size - F.col("b_at"), F.col("p_size") - F.col("p_at")) >= F.col("need"))  # position, in the block's prefix too
        & first)
    return (near.select("row", "id", "at", "n_block_words", "template", "label", overlap.alias("overlap"), "p_size", "need")
            .where(F.col("overlap") >= F.col("need"))
            .select("row", "id", "at", "n_block_words", "template", "label", "overlap",
                    (F.col("overlap").cast("double") / F.col("p_size")).alias("score")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, threshold: int = THRESHOLD) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_blocks (block and template pairs met)."""
    kept = digest(docs, id_col, text_col, templates, threshold)
    met = find_blocks(kept, templates, threshold).groupBy("row").agg(
        F.collect_set("label").alias("more"), F.max("score").alias("best"), F.count(F.lit(1)).alias("n_blocks"))
    none = F.array().cast("array<string>")
    rows = kept.drop("blocks").join(met, "row", "left")

    def listed(labels):
        return F.concat_ws(",", F.array_sort(F.array_distinct(labels)))

    return rows.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", listed(F.col("base")).alias("base_labels"),
        listed(F.concat("base", F.coalesce("more", none))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0).cast("long")).alias("n_blocks"))


def oracle(templates=TEMPLATES, threshold: int = THRESHOLD) -> str:
    """DuckDB SQL for ``scan`` on ``documents``: every block against every template."""
    def sql_list(words):
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    phrases = ", ".join(f"('{label}', {sql_list(p.split())})" for p, label in PHRASES.items())
    wording = ", ".join(f"('{label}', {sql_list(template_words(t))})" for label, t in templates)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
      regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p(label, ph) AS (VALUES {phrases}), t(label, tw) AS (VALUES {wording}),
places AS (SELECT rid, label, i FROM (SELECT rid, w, unnest(range(len(w))) AS i FROM d) x, p
      WHERE w[i + 1] = ph[1] AND w[i + 1:i + len(ph)] = ph),
base AS (SELECT rid, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels FROM places GROUP BY rid),
blocks AS (SELECT rid, list_distinct(w[lo + 1:lo + {2 * STRIDE}]) AS b
      FROM (SELECT rid, w, unnest(range(0, greatest(len(w) - {STRIDE}, 1), {STRIDE})) AS lo FROM d WHERE len(w) > 0) x),
pairs AS (SELECT rid, label, len(list_intersect(tw, b)) AS o, len(tw) AS m FROM blocks, t),
met AS (SELECT rid, list(DISTINCT label) AS labels, max(CAST(o AS DOUBLE) / m) AS best, count(*) AS n_blocks
      FROM pairs WHERE 100 * o >= {threshold} * m GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
    array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, CAST([] AS VARCHAR[])), coalesce(met.labels, CAST([] AS VARCHAR[]))))), ',') AS labels,
    CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score, coalesce(n_blocks, 0) AS n_blocks
FROM d LEFT JOIN base USING (rid) LEFT JOIN met USING (rid)"""
