"""Mixing sources to target weights by entropy balancing.

Sources share a token budget by weight; a source's target stops at a cap
(a multiple of its own size) and the excess is shared again.  Document
rates then minimise the entropy relative to the uniform rate subject to one
token constraint per source; with rates between 0 and the cap the solution
is an exponential tilt, ``rate = cap * sigmoid(prior + tilt)``, whose tilts
are found by Newton steps on the convex dual.  Rates are rounded into whole
copies so that each source's words come out near its target.  DataFrame
functions only.

Edge cases: a null text has size 0 and is never taken; a null source is a
source of its own, ordered last; empty input gives empty output; a source
whose documents are all empty has target 0.  Repeated rows (also of one
doc_id) are separate documents that carry equal source, size and target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barspark.llm.common import let, materialize, ordered_index, word_count


def symbol_prior(text: Column, weight: float = 40.0) -> Column:
    """Prior log-odds of a document: ``weight`` times the share of symbols among its characters, below 0; null or empty: 0."""
    t = F.coalesce(text, F.lit(""))
    return -F.lit(weight) * (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))) / F.greatest(F.length(t), F.lit(1))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
                   cap: float = 2.0) -> DataFrame:
    """``(source, source_size)`` -> the same rows with ``target``.

    Targets are ``min(weight * level, cap * size)`` with the level at which
    they sum to ``share`` of all sizes.  Each round caps the sources above
    their limit and raises the level; the driver sees three sums a round.
    """
    s = ordered_index(sources, F.col("source").asc_nulls_last(), name="place")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    s = materialize(s.withColumn("weight", w).withColumn("limit", F.col("source_size") * F.lit(cap)), "sources")
    level = 0.0
    while True:
        full = F.col("weight") * F.lit(level) >= F.col("limit")
        r = s.agg((F.sum("source_size") * F.lit(share)).alias("total"),
                  F.sum(F.when(full, F.col("limit")).otherwise(0.0)).alias("capped"),
                  F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if r["open"] is None:
            break
        after = (r["total"] - r["capped"]) / r["open"]
        if after <= level:
            break
        level = after
    return s.withColumn("target", F.least(F.col("weight") * F.lit(level), F.col("limit"))).drop("place", "limit")


def tilts(classes: DataFrame, cap: float = 2.0, steps: int = 60) -> DataFrame:
    """Newton steps on the convex dual, every source at once.

    ``classes`` holds one row per (source, prior): the words ``mass`` of its
    documents and the source's ``target``.  The dual's gradient for a source
    is ``sum(mass * rate) - target`` and its curvature
    ``sum(mass * rate * (1 - rate / cap))`` over its classes (at most 129,
    as priors are rounded to sixteenths).  Steps are damped to 2, so that
    they converge from any start; a target at the cap drives the tilt to 40,
    where the rate equals the cap in double precision.
    """
    per = classes.groupBy("source").agg(F.first("target").alias("target"),
                                        F.collect_list(F.struct("prior", "mass")).alias("cls"))
    rate = lambda t, c: F.lit(cap) / (1.0 + F.exp(-t - c["prior"]))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)

    def step(t, _):
        g = total(F.transform("cls", lambda c: c["mass"] * rate(t, c))) - F.col("target")
        h = total(F.transform("cls", lambda c: c["mass"] * rate(t, c) * (1.0 - rate(t, c) / F.lit(cap))))
        move = F.when(h > 0, -g / h).otherwise(F.lit(0.0))
        return F.greatest(F.lit(-40.0), F.least(F.lit(40.0), t + F.greatest(F.lit(-2.0), F.least(F.lit(2.0), move))))

    return per.select("source", F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.lit(0.0), step).alias("tilt"))


def _round(due: Column, size: Column, rows: Column, cap: float) -> Column:
    """Whole copies nearest to the words that are due, within the cap, of ``rows`` equal documents."""
    c = F.greatest(F.lit(0.0), F.least(F.floor(F.lit(cap)) * rows, F.floor(due / F.greatest(size, F.lit(1)) + 0.5)))
    return F.when(size > 0, c).otherwise(F.lit(0)).cast("long")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, cap: float = 2.0,
        prior: Column | str | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        group_rows: int = 2_000) -> DataFrame:
    """One row per document: size, source_size, target, rate, copies and taken (copies * size).

    ``prior`` is a column (or the name of one) with a document's prior log-odds (null: 0, kept
    within -4 and 4, rounded to sixteenths); without it all documents of a
    source get one rate.  Rounding goes through a source's documents from the
    largest to the smallest: each gets the whole copies nearest to what its
    rate and the remainder of those before it make due, so what a source
    misses is less than its smallest documents.  Sources above ``group_rows``
    documents are cut into parts by hash, each rounded alone, so that a hot
    source spreads over tasks and a part's documents fit one row.
    """
    p = F.lit(0.0) if prior is None else F.round(F.greatest(F.lit(-4.0), F.least(F.lit(4.0), F.coalesce(
        (F.col(prior) if isinstance(prior, str) else prior).cast("double"), F.lit(0.0)))) * 16) / 16
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
                    p.alias("prior"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("tie"))
    # rows that are equal in all of these are one entry with a count
    d = materialize(d.groupBy("doc_id", "source", "size", "prior", "tie").agg(F.count(F.lit(1)).alias("rows")), "sizes")
    words = F.col("size") * F.col("rows")
    masses = materialize(d.groupBy("source", "prior").agg(F.sum(words).alias("words"), F.count(F.lit(1)).alias("n")), "classes")
    goal = source_targets(masses.groupBy("source").agg(F.sum("words").alias("source_size"), F.sum("n").alias("n")), weights, share, cap)
    same = lambda a, b, cols: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols]
    classes = masses.alias("m").join(goal.alias("g"), same("m", "g", ["source"])).select(
        "m.source", "prior", F.col("words").cast("double").alias("mass"), "target")
    plan = materialize(goal.alias("g").join(tilts(classes, cap).alias("t"), same("g", "t", ["source"])).select(
        "g.source", "source_size", "target", "tilt", F.ceil(F.col("n") / group_rows).alias("parts")), "tilts")
    rate = F.lit(cap) / (1.0 + F.exp(-F.col("tilt") - F.col("prior")))
    j = d.alias("d").join(plan.alias("p"), same("d", "p", ["source"])).select(
        "d.source", "source_size", "target", F.pmod("tie", "parts").alias("part"),
        F.struct((-F.col("size")).alias("order"), "doc_id", "tie", "size", "rows", rate.alias("rate")).alias("x"))
    g = j.groupBy("source", "source_size", "target", "part").agg(F.array_sort(F.collect_list("x")).alias("xs"))

    def step(s: Column, x: Column) -> Column:
        def after(due: Column) -> Column:
            return let(_round(due, x["size"], x["rows"], cap), lambda c: F.struct(
                (due - c * x["size"]).alias("due"), F.concat(s["copies"], F.array(c)).alias("copies")))

        return let(s["due"] + x["rate"] * x["size"] * x["rows"], after)

    start = F.struct(F.lit(0.0).alias("due"), F.array().cast("array<bigint>").alias("copies"))
    g = g.withColumn("copies", F.aggregate("xs", start, step, lambda s: s["copies"]))
    out = g.select("source", "source_size", "target", F.explode(F.arrays_zip("xs", "copies")).alias("z")).select(
        "source", "source_size", "target", "z.xs.*", F.col("z.copies").alias("total"))
    # equal rows share their copies: each gets the whole part, the first ones what is left
    out = out.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    copies = F.floor(F.col("total") / F.col("rows")) + F.when(F.col("i") <= F.col("total") % F.col("rows"), 1).otherwise(0)
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", "tie", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))


def apply(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (not at all, once or more).

    Rows that are equal in id, source and text share the copies that the mix gives them: each the whole part, and
    the remainder one copy each to the first of them, numbered within their key only.
    """
    m = mix(docs, **settings).groupBy("doc_id", "source", "tie").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_n"))
    m = materialize(m.where("_copies > 0").withColumnsRenamed({"doc_id": "_id", "source": "_source", "tie": "_tie"}), "copies")
    own = docs.withColumn("_own", F.xxhash64("doc_id", "text"))
    meet = [F.col("doc_id").eqNullSafe(F.col("_id")), F.col("source").eqNullSafe(F.col("_source")), F.col("_own") == F.col("_tie")]
    one = own.join(m.where("_n = 1"), meet).withColumn("_times", F.col("_copies"))
    w = Window.partitionBy("_id", "_source", "_tie").orderBy("_tie")
    many = own.join(m.where("_n > 1"), meet).withColumn("_times", F.floor(F.col("_copies") / F.col("_n"))
                                                        + F.when(F.row_number().over(w) <= F.col("_copies") % F.col("_n"), 1).otherwise(0))
    j = one.unionByName(many).where("_times > 0")
    return j.withColumn("_time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))).select(*docs.columns)
