"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """``(a, b)`` links of numbers -> ``(node, comp)``, comp the smallest node reachable; nodes with links only.

    Each round points every node's larger neighbours to its smallest one,
    then every node's smaller neighbours to the smallest of them; links at
    least halve the way to the smallest node, so rounds grow with the
    logarithm of the longest path.  A node with very many links is only ever the
    key of a minimum (summed on the map side) and of a join.  Every round is a written table;
    the driver sees one number a round.
    """
    e = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e = materialize(e, "links")

    def star(both: DataFrame, larger: bool) -> DataFrame:
        low = both.groupBy("x").agg(F.min("y").alias("m"))
        low = low.select("x", F.least("x", "m").alias("m"))
        j = both.join(low, "x")
        j = j.where("y > x") if larger else j
        return j.select(F.col("y").alias("u"), F.col("m").alias("v")).where("u > v")

    before = None
    while True:
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).union(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        large = star(both, True).distinct()
        down = large.select(F.col("u").alias("x"), F.col("v").alias("y"))
        low = down.groupBy("x").agg(F.min("y").alias("m"))
        small = down.join(low, "x").where("y > m").select(F.col("y").alias("u"), F.col("m").alias("v"))
        e = materialize(small.union(low.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct(), "links")
        now = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before == now:
            break
        before = now
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(roots.select("node", F.col("node").alias("comp")))
