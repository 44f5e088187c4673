"""Quality rules: base repetition and length rules, then divergence from the language's histograms.

Two histograms describe a document: its characters by class, and its
common words.  Each language's reference is the mean histogram (each
document counts alike, however long) of the documents of that language that
the base rules keep and that hold few symbols.  A document whose
Jensen-Shannon distance (square root of the divergence, base 2, 0 to 1)
from its reference exceeds a limit is rejected, unless it is too short for
its histogram to mean anything.  The limits are each language's own: a
multiple of the distance that nine in ten of its reference documents keep to,
so junk among the references (up to a tenth of them) does not widen them.
DataFrame functions only.

Edge cases: a null or empty text has no words and fails the base length
rule.  A null language is a language of its own.  Repeated rows are judged
one by one and count twice in the reference.  If no document of a language
passes the base rules there is no reference and the distances are null:
the method then rejects nothing.  The widest limits stand behind the last
reference document as one more, so a language of few long reference documents
has them by the same rule as all.  Columns other than the three read are
dropped by ``judge`` and kept by ``keep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barspark.llm.common import SPACE, let, lower_ascii, materialize, words

# Character classes by Java pattern; what no class takes is the last bin.
CLASSES = {"lower": r"\p{Ll}", "upper": r"\p{Lu}", "digit": r"\p{Nd}", "space": r"\s", "letter": r"\p{Lo}\p{Lm}\p{Lt}",
           "stop": r".,;:'\"\-?()", "symbol": r"#*$%&|<>!@^_=+~{}\[\]/\\"}

# Common function words of the four languages; what no bin takes is the last one.
COMMON_WORDS = [
    "the", "of", "and", "to", "in", "that", "is", "for",
    "der", "die", "und", "das", "ist", "mit", "ein", "den",
    "le", "les", "et", "des", "une", "est", "pour", "que",
    "el", "los", "y", "por", "con", "una", "se", "las",
]


def _repeated(w: Column) -> Column:
    """Number of words in three-word windows that the list holds twice or more."""
    n = F.size(w)

    def covered(pos: Column) -> Column:  # pos: sorted starts of such windows, each covering three words
        nxt = F.slice(pos, 2, F.size(pos))
        gaps = F.zip_with(F.slice(pos, 1, F.size(pos) - 1), nxt, lambda a, b: F.least(F.lit(3), b - a))
        return F.when(F.size(pos) == 0, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3), lambda s, g: s + g))

    def count(tri: Column) -> Column:
        placed = F.sort_array(F.transform(tri, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(placed, lambda st: F.filter(
            F.transform(st, lambda x, j: F.when(
                ((j > 0) & (F.get(st, j - 1)["h"] == x["h"])) | (F.get(st, j + 1)["h"] == x["h"]), x["i"])),
            lambda i: i.isNotNull()))
        return F.when(F.size(F.array_distinct(tri)) == F.size(tri), F.lit(0)).otherwise(let(F.sort_array(twice), covered))

    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.size(h) - 2),
                           lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))

    return F.when(n < 4, F.lit(0)).otherwise(
        let(let(F.transform(w, lambda x: F.xxhash64(x)), windows), count)).cast("long")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: the base counts and the two histograms."""
    t = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.withColumn("w", words(F.col("text")))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(f"[^{SPACE}]"))
    # no two classes share a character, so the others are counted in what the most frequent one leaves
    taken = let(F.regexp_replace("text", f"[{CLASSES['lower']}]+", ""), lambda rest: F.array(
        F.length("text") - F.length(rest),
        *[F.length(F.regexp_replace(rest, F.lit(f"[^{c}]+"), F.lit(""))) for k, c in CLASSES.items() if k != "lower"]))
    short = F.filter("w", lambda x: F.length(x) <= max(map(len, COMMON_WORDS)))  # no longer word is a common one
    common = F.filter(F.transform(short, lower_ascii), lambda x: x.isin(COMMON_WORDS))
    t = t.select(
        "doc_id", "lang", F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("w")).alias("n_repeat_words"),
        F.length("text").alias("n"), taken.alias("taken"), common.alias("common"))
    counts = let(F.col("common"), lambda c: F.transform(
        F.array(*[F.lit(x) for x in COMMON_WORDS]), lambda x: F.size(c) - F.size(F.array_remove(c, x))))
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    return t.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.concat("taken", F.array(F.greatest(F.lit(0), F.col("n") - total(F.col("taken"))))).cast("array<double>").alias("chars"),
        F.concat(counts, F.array(F.col("n_words").cast("int") - F.size("common"))).cast("array<double>").alias("commons"))


def base_failed(min_words: int = 50, repeat_pct: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_pct * F.col("n_words"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two histograms of counts; null if either is empty."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    term = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))

    def js(a: Column, b: Column) -> Column:
        each = F.zip_with(a, b, lambda x, y: (term(x, (x + y) / 2) + term(y, (x + y) / 2)) / 2)
        return F.sqrt(F.greatest(F.lit(0.0), total(each)))

    norm = lambda a: let(total(a), lambda n: F.transform(a, lambda x: x / n))
    return F.when((total(p) > 0) & (total(q) > 0), js(norm(p), norm(q)))


def language_limits(distances: DataFrame, max_char_distance: float, max_word_distance: float, least_char_distance: float = 0.1,
                    least_word_distance: float = 0.2, tail_pct: int = 90, char_factor: float = 4.0,
                    word_factor: float = 1.6) -> DataFrame:
    """``(lang, char_distance, word_distance)`` of reference documents -> limit_lang, char_limit, word_limit per language.

    A limit is ``factor`` times the smallest distance (in steps of 1/10,000)
    that ``tail_pct`` in 100 of the documents and one more, which lies beyond
    all, do not exceed, held between ``least`` and ``max`` (``max`` if only
    that one more is left).  The counts per step are exact and add up over
    tasks; a language has 10,001 steps at most.
    """
    step = lambda c: F.ceil(F.col(c) * 10000).cast("long")
    bins = distances.select("lang", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), step(f"{k}_distance").alias("step")) for k in ("char", "word")])).alias("b"))
    counts = bins.select("lang", "b.k", "b.step").groupBy("lang", "k", "step").agg(F.count(F.lit(1)).alias("n"))
    key = Window.partitionBy("lang", "k")
    counts = counts.withColumns({"upto": F.sum("n").over(key.orderBy("step")), "all": F.sum("n").over(key)})
    at = counts.where(100 * F.col("upto") >= tail_pct * (F.col("all") + 1)).groupBy("lang").agg(*[
        (F.min(F.when(F.col("k") == k, F.col("step"))) / 10000).alias(k) for k in ("char", "word")])
    held = lambda d, low, high: F.least(F.lit(high), F.greatest(F.lit(low), d))
    return at.select(F.col("lang").alias("limit_lang"),
                     held(char_factor * F.col("char"), least_char_distance, max_char_distance).alias("char_limit"),
                     held(word_factor * F.col("word"), least_word_distance, max_word_distance).alias("word_limit"))


def judge(docs: DataFrame, min_words: int = 50, repeat_pct: int = 50, min_chars: int = 200,
          max_char_distance: float = 0.33, max_word_distance: float = 0.75, max_symbol_pct: int = 5,
          own_limits: bool = True, **cols: str) -> DataFrame:
    """One row per document: counts, distances from the language's references, the limits, and the verdict.

    ``min_chars`` characters and ``min_words`` words are the least for which
    the two distances are judged; documents with more than ``max_symbol_pct``
    symbols in 100 word characters are no reference.  With ``own_limits``
    every language has limits of its own, the two ``max`` at most; without,
    the two ``max`` hold for all.  The histograms are stored once (a few
    hundred bytes a document), so the texts are read and cut a single time.
    """
    f = materialize(features(docs, **cols).withColumn("base_failed", base_failed(min_words, repeat_pct)), "quality")
    n = {"chars": len(CLASSES) + 1, "commons": len(COMMON_WORDS) + 1}
    share = lambda c, i: F.avg(F.col(c)[i] / F.aggregate(c, F.lit(0.0), lambda s, x: s + x))
    fit = ~F.col("base_failed") & (100 * F.col("n_symbols") <= max_symbol_pct * F.col("word_chars"))
    ref = f.where(fit).groupBy("lang").agg(*[
        F.array(*[share(c, i) for i in range(k)]).alias(f"ref_{c}") for c, k in n.items()])
    ref = ref.withColumnRenamed("lang", "ref_lang")
    j = f.join(ref, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    j = j.withColumns({"char_distance": distance(F.col("chars"), F.col("ref_chars")),
                       "word_distance": distance(F.col("commons"), F.col("ref_commons"))})
    long_enough = F.aggregate("chars", F.lit(0.0), lambda s, x: s + x) >= min_chars
    j = j.withColumns({"long_enough": long_enough, "fit": fit}).drop("chars", "commons", "ref_chars", "ref_commons", "ref_lang")
    widest = {"char_limit": F.lit(max_char_distance), "word_limit": F.lit(max_word_distance)}
    if own_limits:
        j = materialize(j, "distances")
        limits = language_limits(j.where("fit and long_enough"), max_char_distance, max_word_distance)
        j = j.join(limits, F.col("lang").eqNullSafe(F.col("limit_lang")), "left")
        widest = {c: F.coalesce(c, x) for c, x in widest.items()}
    j = j.withColumns(widest)
    off = F.col("long_enough") & ((F.coalesce("char_distance", F.lit(0.0)) > F.col("char_limit"))
                                  | (F.coalesce("word_distance", F.lit(0.0)) > F.col("word_limit")))
    return j.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "char_distance", "word_distance", "char_limit", "word_limit",
                    (~F.col("base_failed") & ~off).alias("kept"))


def keep(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    Verdicts come back by id and text hash, so rows that share an id are
    judged by their own text.
    """
    th = F.xxhash64("text")
    own = docs.select(F.struct("doc_id", th).alias("doc_id"), "text", "lang")
    good = judge(own, **settings).where("kept").select(F.col("doc_id").alias("_key")).distinct()
    return docs.join(good, F.struct("doc_id", th).eqNullSafe(F.col("_key")), "left_semi")
