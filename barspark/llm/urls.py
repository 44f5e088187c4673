"""URL lists over time: dated entries become validity intervals, captures join them as of their fetch time.

An entry names a pattern (a host, a parent domain, or a host with a path
prefix of whole segments), a date, and an action: ``block``, ``allow`` or ``lift`` (the
pattern is no longer listed).  A pattern's entry holds from its date to the
date of the pattern's next entry; of several on one date the last in
``seq`` holds.  A capture asks for every pattern that its URL falls under;
among the entries active at its fetch time the most specific pattern decides
(path prefixes before hosts, longer ones before shorter ones).

Edge cases: a null or unparsable URL asks for nothing and gets the verdict
``none``, as does a capture before the first entry; a null fetch time
matches nothing; a lift ends the listing; repeated entries collapse to one
interval, repeated captures are each evaluated; an empty list gives ``none`` everywhere.
Captures are never grouped by pattern: the join's larger side streams, and
a hot host's captures are split by Spark's skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def host(url: Column) -> Column:
    """Lower-case host of a URL, null if there is none."""
    h = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(h, F.lit(""))


def patterns(url: Column, depth: int = 2) -> Column:
    """Structs (rank, pattern) of all patterns that a URL falls under, most specific first."""
    h = host(url)
    labels = F.split(h, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        (F.lit(1000) + i).alias("rank"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*(/[^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    paths = F.transform(F.sequence(F.lit(1), F.lit(depth)), lambda i: F.when(F.size(parts) >= i, F.struct(
        (F.lit(1000) - i).alias("rank"), F.concat(h, F.lit("/"), F.array_join(F.slice(parts, F.lit(1), i), "/")).alias("pattern"))))
    return F.when(h.isNotNull(), F.concat(F.filter(paths, lambda x: x.isNotNull()), domains))


def intervals(entries: DataFrame) -> DataFrame:
    """``(pattern, day, seq, action)`` -> ``(pattern, from_day, to_day, action)``; to_day is null while open."""
    e = entries.where("pattern is not null and day is not null").groupBy("pattern", "day").agg(
        F.max_by("action", "seq").alias("action"))
    w = Window.partitionBy("pattern").orderBy("day")
    return e.select("pattern", F.col("day").alias("from_day"), F.lead("day").over(w).alias("to_day"), "action")


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
             day_col: str = "fetch_day") -> DataFrame:
    """One row per capture: id, url, fetch_day, verdict (block, allow or none), pattern, listed_since.

    A capture asks for as many path segments as the list's deepest entry has (one number reaches the driver).
    """
    deepest = entries.agg(F.max(F.size(F.split("pattern", "/")) - 1).alias("n")).first()["n"]
    depth = max(1, deepest or 0)
    c = captures.select(F.col(id_col).alias(id_col), F.col(url_col).alias("url"), F.col(day_col).alias("fetch_day"))
    asked = c.withColumn("_row", F.monotonically_increasing_id()).select(
        "*", F.explode_outer(patterns(F.col("url"), depth)).alias("_p"))
    i = intervals(entries).where("action <> 'lift'").withColumnRenamed("pattern", "_pattern")
    day = F.col("fetch_day")
    held = (F.col("_p.pattern") == F.col("_pattern")) & (day >= F.col("from_day")) & (F.col("to_day").isNull() | (day < F.col("to_day")))
    best = F.min(F.when(F.col("_pattern").isNotNull(), F.struct("_p.rank", "_pattern", "from_day", "action")))
    out = asked.join(i, held, "left").groupBy("_row", id_col, "url", "fetch_day").agg(best.alias("b"))
    return out.select(
        id_col, "url", "fetch_day", F.coalesce("b.action", F.lit("none")).alias("verdict"),
        F.col("b._pattern").alias("pattern"), F.col("b.from_day").alias("listed_since"))
