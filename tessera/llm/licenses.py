"""License scans: exact set-similarity join of text blocks with templates.

A text's words are cut into overlapping blocks. A block matches a template
when it holds at least ``threshold`` of the template's distinct words. Words
are ordered by their frequency over the whole corpus, rarest first, and a
block is compared with a template only if

* it holds enough of the templates' words at all (length filter),
* the rarest words of both meet (prefix filter: of n words of which k must be
  shared, one is among the first n - k + 1), and
* enough words follow the first shared one on both sides (positional filter).

Everything is built-in functions on the row of the document: blocks never
leave it, so nothing is shuffled but the word counts of the templates' words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import required

#: Fixed phrases and labels of the base rule.
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
#: Opening or naming words of public license notices.
TEMPLATES = [
    ("under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("cc by nc", "cc-by-nc"),
    ("licensed under a creative commons attribution noncommercial 4 0 international license", "cc-by-nc"),
    ("licensed under the gnu general public license", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("to the extent possible under law waived all copyright and related or neighboring rights", "cc0"),
]
STRIDE = 24
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text: A-Z in lower case, cut at ASCII characters that are
    neither letters nor digits. The Kelvin sign is kept from becoming a k;
    other letters beyond ASCII may change case but never become ASCII words."""
    plain = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ")))
    return F.array_remove(F.split(plain, SEPARATORS), "")


def places(found: Column, phrase: str) -> Column:
    """Starts (from 0) of a phrase's words in an array of words."""
    def narrowed(starts: Column, k: int, part: str) -> Column:
        return F.filter(starts, lambda i: F.get(found, i + k) == part)

    parts = phrase.split()
    starts = F.sequence(F.lit(0), F.size(found) - len(parts))
    for k, part in enumerate(parts):
        starts = narrowed(starts, k, part)
    return starts


def word_counts(docs: DataFrame, vocabulary: list[str]) -> dict[str, int]:
    """Number of documents with each of a few words, over all documents."""
    held = F.array_intersect(F.lit(vocabulary), words(F.col("text")))
    return {r["word"]: r["count"] for r in docs.select(F.explode(held).alias("word")).groupBy("word").count().collect()}


def scan(docs: DataFrame, threshold: float = 0.8, templates: list[tuple[str, str]] | None = None,
         phrases: list[tuple[str, str]] | None = None) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score).

    ``n_base``: places of the phrases, ``first_word`` and ``last_word`` their
    smallest and largest start (null if none), ``base_labels`` their labels;
    ``labels`` also holds those of matching templates; ``score`` is the
    largest share of a template's words found in a block (1 for a phrase, 0
    without a match). Null and empty texts have no words. Repeated rows stay;
    an empty table gives none. A template of up to ``STRIDE`` words always lies
    within one block of twice that size; longer templates are looked for in
    blocks of their own, of twice ``STRIDE``, 2 ``STRIDE``, 4 ``STRIDE`` ... words, so a
    template may be a whole license text.
    """
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    docs = required(docs, {"doc_id": "long", "text": "string"})
    vocabulary = sorted({w for t, _ in templates for w in t.split()})
    counts = word_counts(docs, vocabulary)
    ordered = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(ordered)}
    index: dict[int, list] = {}
    for text, label in templates:
        tokens = sorted(set(text.split()), key=rank.get)
        need = max(1, math.ceil(threshold * len(tokens) - 1e-9))
        stride = STRIDE << max(0, math.ceil(math.log2(max(1, len(text.split())) / STRIDE)))
        index.setdefault(stride, []).append((label, tokens, tokens[:len(tokens) - need + 1], need))
    rare = sorted({w for part in index.values() for _, _, prefix, _ in part for w in prefix})

    def matches(block: Column, part: list) -> Column:
        """(label, share) of each template of ``part`` the block holds, else null."""
        out = []
        for label, tokens, prefix, need in part:
            all_, head = F.lit(tokens), F.lit(prefix)
            first = F.get(F.array_intersect(F.slice(block, F.lit(1), F.size(block) - need + 1), head), F.lit(0))
            room = 1 + F.least(len(tokens) - F.array_position(all_, first), F.size(block) - F.array_position(block, first))
            shared = F.size(F.array_intersect(block, all_))
            # CASE so that the dearer tests run only where the cheaper ones pass
            held = F.when(F.size(block) < need, F.lit(False)).when(first.isNull(), F.lit(False)).when(room < need, F.lit(False)).otherwise(shared >= need)
            out.append(F.when(held, F.struct(F.lit(label).alias("label"), (shared / float(len(tokens))).alias("share"))))
        return F.array_compact(F.array(*out))

    read = docs.select("doc_id", words(F.col("text")).alias("words"))
    n = F.size("words")
    joined = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    read = read.select("doc_id", "words", n.alias("n_words"), joined.alias("joined"),
                       F.arrays_overlap("words", F.lit(rare)).alias("candidate"))

    def found_in_blocks(stride: int) -> Column:
        part = index[stride]
        held = {w for _, tokens, _, _ in part for w in tokens}
        own_words = [w for w in ordered if w in held]
        starts = F.sequence(F.lit(0), F.greatest(F.col("n_words") - stride - 1, F.lit(0)), F.lit(stride))
        blocks = F.transform(starts, lambda s: F.array_intersect(F.lit(own_words), F.slice("words", s + 1, 2 * stride)))
        return F.flatten(F.transform(blocks, lambda block: matches(block, part)))

    found = [found_in_blocks(stride) for stride in sorted(index)]
    found = F.concat(*found) if len(found) > 1 else found[0]
    base = {f"at{k}": F.when(F.contains("joined", F.lit(f" {p} ")), places(F.col("words"), p)).otherwise(F.array().cast("array<int>"))
            for k, (p, _) in enumerate(phrases)}
    none = F.array().cast("array<struct<label:string,share:double>>")
    read = read.select("doc_id", "n_words", F.when(F.col("candidate"), found).otherwise(none).alias("found"),
                       *[c.alias(k) for k, c in base.items()])
    all_places = F.concat(*base)
    own = F.array_compact(F.array(*[F.when(F.size(f"at{k}") > 0, F.lit(label)) for k, (_, label) in enumerate(phrases)]))
    return read.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), F.size(all_places).cast("long").alias("n_base"),
        F.array_min(all_places).cast("long").alias("first_word"), F.array_max(all_places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(own)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, F.col("found.label"))), ",").alias("labels"),
        F.when(F.size(all_places) > 0, 1.0).otherwise(F.coalesce(F.array_max("found.share"), F.lit(0.0))).alias("score"))
