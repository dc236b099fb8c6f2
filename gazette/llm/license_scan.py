"""License scans: an exact set-similarity join of text blocks with templates.

A template is a short license notice.  Its tokens and a text block's are sets,
ordered by how many documents hold a token, rarest first.  A block contains a
template if it holds at least ``threshold`` of the template's tokens.  Pairs
come from an equi-join on the tokens of both prefixes, with length and
positional filters; the overlap of what is left is counted exactly.

Blocks: for templates of at most c words (c a power of two, 8 at least), the
runs of 2c consecutive words that start at multiples of c.  Any c + 1
consecutive words of a text lie inside one block, and a block is never much
longer than the templates it is held against.

Everything runs as DataFrame functions; a block keeps only tokens that stand
in some template of its class, which the overlap can't tell from the whole block.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import id_and_text, staged, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What parts words: ASCII other than digits and a-z (texts are folded first).
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: (words in a row, label)
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: (label, notice)
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is "
                   "distributed on an AS IS basis, without warranties or conditions of any kind, either express or implied"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("public-domain", "This work has been released into the public domain by its author"),
)
THRESHOLD = "0.9"
LEAST_CLASS = 8


def words_of(text: str) -> list[str]:
    return [w for w in re.split(GAP, text.translate(str.maketrans(UPPER, LOWER))) if w]


def block_class(n_words: int) -> int:
    """Least power of two that is no less, LEAST_CLASS at least."""
    return max(LEAST_CLASS, 1 << max(0, n_words - 1).bit_length())


def template_sets(templates: Sequence[tuple[str, str]], threshold: str) -> list[tuple[int, str, tuple[str, ...], int]]:
    """(class, label, distinct tokens, least overlap) of each template."""
    out = []
    for label, notice in templates:
        words = words_of(notice)
        if words:
            tokens = tuple(dict.fromkeys(words))
            out.append((block_class(len(words)), label, tokens, max(1, ceil(Fraction(threshold) * len(tokens)))))
    return out


def _words(text: Column) -> Column:
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(folded, GAP), "")


def _strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _phrase_places(phrases: Sequence[tuple[str, str]]) -> tuple[Column, Column, Column, Column]:
    """(places, smallest start, largest start, labels) of the phrases in the
    array column ``_w``.  Each word stands between spaces of its own, so that a
    split by the phrase loses no neighbour and a piece has two spaces a word."""
    def in_words(piece: Column) -> Column:
        return ((F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))) / 2).cast("long")

    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases:
        words = words_of(phrase)
        if not words or any(words[:k] == words[-k:] for k in range(1, len(words))):
            raise ValueError(f"a phrase needs words and may not overlap itself: {phrase!r}")
        pieces = F.split(F.col("_line"), r"\Q " + "  ".join(words) + r" \E")
        n = F.size(pieces).cast("long") - 1
        counts.append(n)
        firsts.append(F.when(n > 0, in_words(F.element_at(pieces, 1))))
        lasts.append(F.when(n > 0, F.size("_w").cast("long") - in_words(F.element_at(pieces, -1)) - len(words)))
        labels.append(F.when(n > 0, F.lit(label)))
    total = counts[0]
    for n in counts[1:]:
        total = total + n
    return (total, F.array_min(F.array(*firsts)), F.array_max(F.array(*lasts)),
            F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))))


def _blocks(kind: int, vocabulary: Sequence[str], least: int) -> Column:
    """The class's blocks that hold enough of its vocabulary (the length
    filter), each as its tokens in the order of ``vocabulary``."""
    n = F.size("_w")
    last = F.greatest(F.ceil(n / kind) - 2, F.lit(0)).cast("int")
    every = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
        F.lit(kind).alias("kind"), (i * kind).cast("long").alias("start"),
        F.array_intersect(_strings(vocabulary), F.slice(F.col("_w"), i * kind + 1, F.lit(2 * kind))).alias("tokens")))
    return F.filter(every, lambda b: F.size(b["tokens"]) >= least)


def _index(spark, sets, rank) -> DataFrame:
    """Prefix tokens of the templates; as many rows as the templates have tokens at most."""
    rows = []
    for number, (kind, label, tokens, least) in enumerate(sets):
        ordered = sorted(tokens, key=rank.__getitem__)
        rows += [F.struct(F.lit(kind).alias("kind"), F.lit(t).alias("token"), F.lit(number).alias("template"), F.lit(label).alias("label"),
                          F.lit(i).alias("at"), F.lit(len(ordered)).alias("size"), F.lit(least).alias("least"),
                          _strings(ordered).alias("wanted")) for i, t in enumerate(ordered[:len(ordered) - least + 1])]
    return spark.range(1).select(F.inline(F.array(*rows)))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES, templates=TEMPLATES,
                 threshold: str = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(documents, blocks).

    documents: one row per row of ``docs``: ``n_words``, the phrases' places
    (``n_base``, ``first_word``, ``last_word``, ``base_labels``), all ``labels`` and a
    ``score``: 1 with a phrase, else the greatest containment of a block that
    meets the threshold, else 0.  blocks: one row per such block and template:
    ``_row`` (the document's, as in documents), start (in words), template,
    label, containment.

    Null text counts as empty: no words, no labels, score 0.  Repeated rows and
    equal or null ids are rows of their own; ties between templates give all
    their labels; an empty table gives empty results; other columns of the
    input are ignored.  A very long text is one row with its words and blocks.
    The text is read twice: to count how many documents hold each template
    token (as many rows as there are such tokens come to the driver), and to
    find phrases and blocks; what passes the length filter is written once.
    """
    spark = docs.sparkSession
    sets = template_sets(templates, threshold)
    if not sets:
        raise ValueError("no template with a word")
    rows = id_and_text(docs, id_col, text_col)
    every = sorted({t for _, _, tokens, _ in sets for t in tokens})
    seen = rows.select(F.explode(F.array_intersect(_strings(every), _words(F.col("_text")))).alias("token"))
    count = {r["token"]: r["count"] for r in seen.groupBy("token").count().collect()}
    ordered = sorted(every, key=lambda t: (count.get(t, 0), t))
    rank = {t: i for i, t in enumerate(ordered)}

    blocks = []
    for kind in sorted({s[0] for s in sets}):
        own = [s for s in sets if s[0] == kind]
        held = {t for s in own for t in s[2]}
        blocks.append(_blocks(kind, [t for t in ordered if t in held], min(s[3] for s in own)))
    cut = rows.select("_id", _words(F.col("_text")).alias("_w"))
    lined = cut.withColumn("_line", F.concat(F.lit(" "), F.array_join("_w", "  "), F.lit(" ")))
    n_base, first, last, named = _phrase_places(phrases)
    found = lined.select(F.monotonically_increasing_id().alias("_row"), "_id", F.size("_w").cast("long").alias("n_words"), n_base.alias("n_base"),
                         first.alias("first_word"), last.alias("last_word"), named.alias("_named"), F.concat(*blocks).alias("_blocks"))
    found = staged(found, "licenses")     # from here on a row's number is fixed

    least = {k: min(s[3] for s in sets if s[0] == k) for k in {s[0] for s in sets}}
    least_of = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in least.items()])
    held = found.filter(F.size("_blocks") > 0).select("_row", F.inline("_blocks"))
    prefixes = held.select("_row", "kind", "start", "tokens",
                           F.posexplode(F.slice("tokens", F.lit(1), F.size("tokens") - least_of + 1)).alias("_at", "token"))
    index = F.broadcast(_index(spark, sets, rank))
    rest = F.least(F.size("tokens") - F.col("_at"), F.col("size") - F.col("at"))
    pairs = prefixes.join(index, ["kind", "token"]).filter((F.size("tokens") >= F.col("least")) & (rest >= F.col("least")))
    overlap = F.size(F.array_intersect("wanted", "tokens"))
    hits = (pairs.filter(overlap >= F.col("least"))
            .select("_row", "start", "template", "label", (overlap / F.col("size")).alias("containment")).distinct())

    per_row = hits.groupBy(F.col("_row").alias("_hit")).agg(F.collect_set("label").alias("_more"), F.max("containment").alias("_best"))
    joined = found.drop("_blocks").join(per_row, F.col("_row") == F.col("_hit"), "left")
    more = F.coalesce("_more", F.array().cast("array<string>"))
    documents = joined.select(
        "_row", F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join("_named", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("_named", more)), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"))
    return documents, hits


def op11_license_scan(spark, sf_dir: str) -> DataFrame:
    documents, _ = license_scan(table(spark, sf_dir, "documents"))
    return documents.drop("_row")


def _sql(phrases=PHRASES, templates=TEMPLATES, threshold: str = THRESHOLD) -> str:
    """The same results from all pairs of blocks and templates."""
    sets = template_sets(templates, threshold)
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    wanted = ", ".join(f"({kind}, '{label}', {listed(tokens)}, {least})" for kind, label, tokens, least in sets)
    base = ", ".join(f"({listed(words_of(p))}, '{label}')" for p, label in phrases)
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), phrases(p, label) AS (VALUES {base}), templates(kind, label, tokens, least) AS (VALUES {wanted}),
places AS (
  SELECT r, label, i FROM (SELECT r, w, p, label, unnest(range(0, len(w) - len(p) + 1)) AS i FROM d, phrases WHERE len(w) >= len(p))
  WHERE w[i + 1:i + len(p)] = p
), base AS (
  SELECT r, count(*) AS n, min(i) AS lo, max(i) AS hi, list_sort(list_distinct(list(label))) AS labels FROM places GROUP BY r
), kinds AS (SELECT DISTINCT kind FROM templates),
blocks AS (
  SELECT r, kind, list_distinct(w[k * kind + 1:k * kind + 2 * kind]) AS b
  FROM (SELECT r, w, kind, unnest(range(0, greatest(CAST(ceil(len(w) / kind) AS BIGINT) - 1, 1))) AS k FROM d, kinds)
), hits AS (
  SELECT r, list_distinct(list(label)) AS labels, max(o / n) AS best
  FROM (SELECT r, label, least, len(tokens) AS n, len(list_intersect(b, tokens)) AS o FROM blocks JOIN templates USING (kind)) WHERE o >= least GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(hits.labels, [])))), ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN hits USING (r)
"""


OP11_SQL = _sql()
