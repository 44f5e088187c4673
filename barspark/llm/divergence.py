"""Source divergence audit: how far each source's words lie from those of its language, by count cells.

Terms that occur equally often in a source and in its language have equal
shares, so nothing is evaluated or ranked term by term: the terms of a
source fall into cells by (count in the source, count in the language), the
divergence is computed once per cell, cells of equal value are merged, and
the cumulated sizes of the cells say which ranks a value takes.  Only the
terms of values that reach the asked ranks are spelled out, in UTF-8 order.
Sources of one language are compared with each other in the same way: the
terms of a bucket are grouped by their counts in all sources and each
distinct row of counts is evaluated once, with its multiplicity.

Tasks count terms in memory, piece by piece, before anything is shuffled, so
a source or a term that holds a third of the corpus reaches the shuffle as a
few rows a task.  A bucket of the comparison holds a bounded number of counts
(terms times sources), however large the language.

Edge cases: null texts, languages and sources are read as empty strings; a
group without terms is compared with the others all the same; a language
without kept terms has pair values of 0 and no term rows; a language with one
source has no pairs; repeated rows are documents of their own; an empty table gives no rows.  Other
columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barspark.llm.common import materialize

#: Terms over UTF-8 bytes: every byte of a character beyond ASCII is 0x80 or more.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
SCALE = 1_000_000_000
#: Entries that a task counts before it hands them on, and counts (terms times sources) in a bucket of the comparison.
PIECE, BUCKET = 300_000, 100_000


def _count(it):
    """Batches of (lang, source, text) -> occurrences and documents of every term, piece by piece."""
    n: dict = {}
    docs: dict = {}

    def flush():
        for (lang, source), c in n.items():
            d = docs[lang, source]
            terms = list(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms)), pa.array([source] * len(terms)), pa.array(terms, pa.binary()).cast(pa.string()),
                 pa.array(c.values(), pa.int64()), pa.array([d[t] for t in terms], pa.int64())],
                ["lang", "source", "term", "n", "docs"])
        n.clear()
        docs.clear()

    held = 0
    for batch in it:
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(),
                                      batch.column("text").cast(pa.binary()).to_pylist()):
            terms = TERM.findall(text.lower())  # bytes: A to Z only
            if not terms:
                continue
            c, d = n.setdefault((lang, source), Counter()), docs.setdefault((lang, source), Counter())
            held -= len(c)
            c.update(terms)
            d.update(set(terms))
            held += len(c)
            if held > PIECE:
                yield from flush()
                held = 0
    yield from flush()


def kept_counts(docs: DataFrame, min_docs: int = 3) -> DataFrame:
    """``(lang, source, text)`` -> lang, source, term, n, lang_n, lead (true on one row of each term of a language).

    Only terms in at least ``min_docs`` documents of the language.  One
    shuffle by (lang, term) serves the sums and the windows.
    """
    part = docs.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    c = part.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    w = Window.partitionBy("lang", "term")
    c = c.select("lang", "source", "term", "n", F.sum("docs").over(w).alias("docs"), F.sum("n").over(w).alias("lang_n"),
                 (F.min("source").over(w) == F.col("source")).alias("lead"))
    return c.where(F.col("docs") >= min_docs).drop("docs")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exact."""
    wide = lambda c: c.cast("decimal(20,0)")
    over = F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + 1), wide(total + terms))
    return F.lit(1).cast("long") + over


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def term_ranks(kept: DataFrame, groups: DataFrame, top: int = 200) -> DataFrame:
    """The ``top`` terms of every group whose share exceeds the language's: lang, source, item, value, rank."""
    cells = kept.groupBy("lang", "source", "n", "lang_n").agg(F.count(F.lit(1)).alias("m")).join(groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    cells = cells.withColumns({"p": p, "q": q}).where("p > q").select(
        "lang", "source", "n", "lang_n", "m", gap(F.col("p"), F.col("q")).alias("value"))
    falling = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    merged = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    merged = merged.withColumn("place", F.row_number().over(falling)).where(F.col("place") <= top)  # each value has a term at least
    merged = merged.withColumn("before", F.sum("m").over(falling) - F.col("m")).where(F.col("before") < top)
    chosen = cells.drop("m").join(merged.drop("m", "place"), ["lang", "source", "value"])
    terms = kept.select("lang", "source", "n", "lang_n", "term").join(chosen, ["lang", "source", "n", "lang_n"])
    named = Window.partitionBy("lang", "source", "value").orderBy("term")
    terms = terms.withColumn("i", F.row_number().over(named)).where(F.col("i") <= top)
    rank = (F.col("before") + F.col("i")).cast("int")
    return terms.select("lang", "source", F.col("term").alias("item"), "value", rank.alias("rank")).where(F.col("rank") <= top)


def _shares(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    if counts.size and int(counts.max()) >= (1 << 63) // SCALE - 1:
        return (1 + (SCALE * (counts.astype(object) + 1)) // total.astype(object)).astype(np.int64)
    return 1 + (SCALE * (counts + 1)) // total


def _compare(key, kept: pa.Table, sources: pa.Table) -> pa.Table:
    """One bucket of a language's terms: the summed divergence of every source from every other one."""
    names = sources.column("source").to_pylist()
    at = {s: i for i, s in enumerate(names)}
    value = np.zeros((len(names), len(names)), np.int64)
    if kept.num_rows:
        term = kept.column("term").combine_chunks().dictionary_encode()
        row = term.indices.to_numpy(zero_copy_only=False)
        column = np.array([at[s] for s in kept.column("source").to_pylist()])
        counts = np.zeros((len(term.dictionary), len(names)), np.int64)
        counts[row, column] = kept.column("n").to_numpy()
        cells, times = np.unique(counts, axis=0, return_counts=True)
        p = _shares(cells, sources.column("total").to_numpy() + sources.column("terms").to_numpy())
        for i in range(len(names)):
            value[i] = ((p[:, i:i + 1] - p) ** 2 // p * times[:, None]).sum(0)
    first, second = np.nonzero(~np.eye(len(names), dtype=bool))
    take = lambda i: pa.array(names, pa.string()).take(pa.array(i))
    return pa.table({"lang": pa.array([key[0].as_py()] * len(first), pa.string()), "source": take(first), "item": take(second),
                     "value": pa.array(value[first, second], pa.int64())})


def pair_ranks(kept: DataFrame, groups: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Every other source of the language for every group: lang, source, item, value, rank.

    Rows are as many as pairs of sources asked for; terms never leave their
    bucket, which adds up what its terms contribute to each pair.  A bucket
    holds ``bucket`` counts, or four for each pair it gives where sources are many.
    """
    n = F.count(F.lit(1))
    parts = groups.groupBy("lang").agg(F.greatest(F.lit(1.0), F.ceil(F.max("terms") * n / F.greatest(F.lit(bucket), 4 * n * n))).cast("long").alias("parts"))
    sources = groups.join(parts, "lang").select("lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("bucket"),
                                                "source", "total", "terms")
    dealt = kept.join(parts, "lang").select("lang", F.pmod(F.xxhash64("term"), "parts").alias("bucket"), "source", "term", "n")
    sums = (dealt.groupBy("lang", "bucket").cogroup(sources.groupBy("lang", "bucket"))
            .applyInArrow(_compare, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    w = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return sums.withColumn("rank", F.row_number().over(w))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = 3,
          top: int = 200) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value and rank, as the module says."""
    d = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(name) for name, c in
                      (("lang", lang_col), ("source", source_col), ("text", text_col))])
    kept = materialize(kept_counts(d, min_docs), "divergence_counts")
    of_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("lead").alias("terms"))
    groups = d.select("lang", "source").distinct().join(of_source, ["lang", "source"], "left").join(of_lang, "lang", "left")
    groups = materialize(groups.na.fill(0), "divergence_groups")
    out = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return out(pair_ranks(kept, groups), "pair").union(out(term_ranks(kept, groups, top), "term"))
