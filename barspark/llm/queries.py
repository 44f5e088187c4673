"""Registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from barspark.llm import (divergence, htmltext, licenses, lm, mixing, oracle, pigeonhole, quality, recompress, sentencepieces,
                          toxicity, urls, whitening, winnow)
from barspark.llm.common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


def _hex(col, n: int = 6):
    """A number from the first hex digits of a text's md5, the same in both engines."""
    return F.conv(F.substring(F.md5(col), 1, n), 16, 10).cast("long")


@register("op1_urls", oracle.OP1)
def op1_urls(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", "page_id", "url").withColumn("fetch_day", _hex(F.col("page_id").cast("string")) % 365)
    p = pages.select(urls.host(F.col("url")).alias("host"), F.explode(urls.patterns(F.col("url"), 1)).alias("p"))
    names = (p.where((F.col("p.rank") == 999) | (F.col("p.pattern") == F.col("host"))
                     | ((F.size(F.split("p.pattern", r"\.")) == 3) & (F.col("p.rank") > 1000)))
             .select("p.pattern").distinct().withColumn("x", _hex(F.col("pattern"))).where("x % 3 <> 0"))
    entry = lambda day, seq, action: F.struct(day.alias("day"), F.lit(seq).alias("seq"), action.alias("action"))
    x = F.col("x")
    entries = names.select("pattern", F.explode(F.array(
        entry(x % 300, 0, F.when(F.floor(x / 7) % 4 == 0, F.lit("allow")).otherwise(F.lit("block"))),
        entry(x % 300 + 20 + x % 50, 1, F.lit("lift")),
        entry(F.when(x % 2 == 0, x % 300 + 50 + x % 50), 2, F.lit("block")))).alias("e")).select("pattern", "e.*")
    return urls.evaluate(pages, entries)


@register("op2_html")
def op2_html(spark, sf_dir):
    e = htmltext.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    text = F.array_join("blocks", "\n\n")
    return e.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))


@register("op3_lm")
def op3_lm(spark, sf_dir):
    s = lm.score(table(spark, sf_dir, "documents", "doc_id", "text"), lower=True)
    return s.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op4_licenses", oracle.OP4)
def op4_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


#: A public pair model with byte fallback; any model file that the driver can read will do.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@register("op5_sentencepiece")
def op5_sentencepiece(spark, sf_dir, model: str = MODEL):
    return sentencepieces.encode(table(spark, sf_dir, "documents", "doc_id", "text"), model, ids=False)


@register("op6_quality", oracle.OP6)
def op6_quality(spark, sf_dir):
    j = quality.judge(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))
    return j.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", *[
        F.round(c, 6).alias(c) for c in ("char_distance", "word_distance", "char_limit", "word_limit")])


@register("op7_mixing")
def op7_mixing(spark, sf_dir):
    m = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "text", "source"), prior=mixing.symbol_prior(F.col("text")))
    return m.select("doc_id", "size", "source_size", "target", "taken", F.round("rate", 9).alias("rate"))


@register("op8_fingerprints")
def op8_fingerprints(spark, sf_dir):
    c = winnow.compare_edited(table(spark, sf_dir, "documents", "doc_id", "text"))
    return c.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    winnow.digest(F.col("p")).alias("fingerprint"), winnow.digest(F.col("q")).alias("edited_fingerprint"),
                    "near_edited", "near_next")


@register("op9_substrings", oracle.OP9)
def op9_substrings(spark, sf_dir):
    r = recompress.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"), keep_text=False)
    return r.drop("th")


@register("op10_jaccard", oracle.OP10)
def op10_jaccard(spark, sf_dir):
    n = pigeonhole.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))
    return n.select("doc_id", "n_shingles", "component_id")


@register("op11_divergence", oracle.OP11)
def op11_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents", "text", "lang", "source"))


@register("op12_whitening")
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@register("op13_toxicity")
def op13_toxicity(spark, sf_dir):
    s = toxicity.score(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"), matches=False)
    return s.select("doc_id", "held_out", "score", "predicted", "n_words", "n_matched")
