"""License scans: known phrases, and an exact set-similarity join of text blocks with templates.

A block is a run of a text's words, a quarter longer than the template (so a
notice is found however its lines are cut, a few words of comment marks
included, and words scattered over a long line are none).  It matches a template
if it contains at least ``containment`` of the template's distinct words.  Words are ordered by
their frequency in the corpus, rarest first; a block that meets the
threshold must hold one of the template's first ``|T| - needed + 1`` words
(prefix filter), must have enough words (length filter) and, as it is found
by the rarest word that it shares with the template, enough of the words
behind that one in the order (positional filter).  What is left is verified
by intersection.
Everything is DataFrame functions; templates and their words are a bounded
list of parameters.

Edge cases: a null or empty text has no words, no labels and score 0; blocks
without words never match; repeated rows get equal results; a document's
score is the largest containment among its matches, 0 without one.  Other
columns are not read.  With an empty table all results are empty (the word
order is then alphabetic).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import let, lower_ascii

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"

# Phrases whose words must stand side by side, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Sentences of well-known license notices, and their labels.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("proprietary", "all rights reserved no part of this publication may be reproduced without permission"),
]


def may_hold(lowered: Column, some: list[str]) -> Column:
    """Whether a word begins like one of ``some``: a cheap test before words are cut; only places after a separator are tried."""
    return F.concat(F.lit(" "), lowered).rlike(f"{BETWEEN}(?:{'|'.join(some)})")


def block_words(lowered: Column) -> Column:
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def places(w: Column) -> Column:
    """Start places of every phrase: structs of place and label, by place."""
    def starts(words: Column) -> Column:
        def here(i: Column) -> Column:
            found = []
            for phrase, label in PHRASES.items():
                parts = phrase.split()
                same = reduce(lambda a, b: a & b, [F.get(words, i + j) == p for j, p in enumerate(parts)])
                found.append(F.when(same, F.struct(i.alias("at"), F.lit(label).alias("label"))))
            return F.filter(F.array(*found), lambda x: x.isNotNull())

        n = F.size(words)
        return F.flatten(F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), here))

    return let(w, starts)


def word_order(docs: DataFrame, vocabulary: list[str]) -> list[str]:
    """The templates' words, rarest in the corpus first (one count per template word reaches the driver)."""
    w = F.filter(block_words(lower_ascii(F.col("text"))), lambda x: x.isin(vocabulary))
    counts = docs.select(F.explode(w).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    n = {r["w"]: r["n"] for r in counts.collect()}  # at most len(vocabulary) rows
    return sorted(vocabulary, key=lambda x: (n.get(x, 0), x))


def match_blocks(docs: DataFrame, templates=TEMPLATES, containment: float = 0.9) -> DataFrame:
    """``(doc_id, th, text)`` -> doc_id, th, block, template, label, containment of the blocks that match.

    ``block`` is the place of the template word that the run was found by;
    the containment is that of the best run around it.
    """
    sets = [sorted(set(t.split())) for _, t in templates]
    vocabulary = sorted(set().union(*map(set, sets)))
    rank = {w: i for i, w in enumerate(word_order(docs, vocabulary))}
    lengths = [len(t.split()) + len(t.split()) // 4 for _, t in templates]
    index = []
    for i, (label, _) in enumerate(templates):
        order = sorted(sets[i], key=rank.get)
        needed = -(-len(order) * round(containment * 1000) // 1000)
        for j, w in enumerate(order[: len(order) - needed + 1]):
            index.append((w, i, label, len(order), needed, order[j:], order, lengths[i]))
    prefix, longest = sorted({r[0] for r in index}), max(lengths, default=1)
    index = docs.sparkSession.createDataFrame(index, "w string, template int, label string, size int, needed int, "
                                                     "rest array<string>, tokens array<string>, length int")
    w = docs.select("doc_id", "th", lower_ascii(F.col("text")).alias("low")).where(may_hold(F.col("low"), prefix))
    w = w.select("doc_id", "th", block_words(F.col("low")).alias("words"))
    near = let(F.col("words"), lambda x: F.filter(F.transform(x, lambda y, i: F.when(y.isin(prefix), F.struct(
        i.alias("at"), y.alias("w"), F.least(i, F.lit(longest - 1)).alias("here"),
        F.slice(x, F.greatest(F.lit(1), i - longest + 2), F.lit(2 * longest - 1)
                - F.greatest(F.lit(0), F.lit(longest - 1) - i)).alias("around")))), lambda y: y.isNotNull()))
    r = w.select("doc_id", "th", F.explode(near).alias("x")).select("doc_id", "th", "x.*").join(index, "w")
    r = r.where(F.size("around") >= F.col("needed"))
    r = r.where(F.size(F.array_intersect("around", "rest")) >= F.col("needed"))
    first = F.greatest(F.lit(0), F.col("here") - F.col("length") + 1)
    best = F.array_max(F.transform(F.sequence(first, F.col("here")), lambda s: F.size(
        F.array_intersect(F.slice("around", s + 1, F.col("length")), "tokens"))))
    r = r.withColumn("both", best).where("both >= needed")
    return r.select("doc_id", "th", F.col("at").alias("block"), "template", "label", (F.col("both") / F.col("size")).alias("containment"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES,
         containment: float = 0.9) -> DataFrame:
    """One row per document: n_words, base places and labels, the join's labels, and the score."""
    d = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.withColumn("th", F.xxhash64("text"))
    found = match_blocks(d, templates, containment).groupBy("doc_id", "th").agg(
        F.max("containment").alias("best"), F.collect_set("label").alias("more"))
    low = lower_ascii(F.col("text"))
    base = F.when(low.contains("license"), places(block_words(low))).otherwise(F.array().cast("array<struct<at:int,label:string>>"))
    d = d.select("doc_id", "th", F.regexp_count("text", F.lit(ANY_CASE)).cast("long").alias("n_words"), base.alias("places"))
    f = found.withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    j = d.join(f, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")
    own = F.array_sort(F.array_distinct(F.transform("places", lambda x: x["label"])))
    both = F.array_sort(F.array_distinct(F.concat(own, F.coalesce("more", F.array().cast("array<string>")))))
    at = F.transform("places", lambda x: x["at"])
    return j.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                    F.array_min(at).cast("long").alias("first_word"), F.array_max(at).cast("long").alias("last_word"),
                    F.array_join(own, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"), F.coalesce("best", F.lit(0.0)).alias("score"))
