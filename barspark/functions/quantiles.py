"""Exact per-key quantiles (linear interpolation) without one task per key.

Values are counted per (key, value) first, with map-side partial counts, so
a value that fills a third of a key is one row.  The counted values of a
key are cut into pieces at ``percentile_approx`` points (a sketch of
bounded size per key); running counts per piece and piece offsets give every
value the ranks that it holds, and the rows at the two ranks around each requested
position are interpolated like ``percentile``:
``(hi - pos) * v[lo] + (pos - lo) * v[hi]``, ``pos = (n - 1) p``.  The same
plan serves keys of all sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PIECES = 64


def exact_quantiles(df: DataFrame, keys: list[str], columns: list[str] | str, probs: list[float],
                    pieces: int = PIECES) -> DataFrame:
    """(keys..., ``<column>_q<i>`` for every column and probability) over non-null values.

    ``pieces`` is the number of tasks that a key's ranking may spread over."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    v = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_v")) for c in columns])).alias("_s"))
    v = v.select(*keys, "_s.*").filter(F.col("_v").isNotNull())
    q = _ranked_quantiles(v, [*keys, "_c"], probs, pieces)
    names = [f"{c}_q{i}" for c in columns for i in range(len(probs))]
    wide = q.groupBy(*keys).agg(*[F.max(F.when(F.col("_c") == c, F.col(f"_q{i}"))).alias(f"{c}_q{i}")
                                  for c in columns for i in range(len(probs))])
    return df.select(*keys).distinct().join(wide, keys, "left").select(*keys, *names)


def _ranked_quantiles(v: DataFrame, keys: list[str], probs: list[float], pieces: int) -> DataFrame:
    """``v``: keys and ``_v``; one row per key with ``_q0``, ``_q1``, ..."""
    n = v.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", F.array(*[F.lit(i / pieces) for i in range(1, pieces)]), 4 * pieces).alias("_cuts"))
    counted = v.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_m")).join(n, keys)
    counted = counted.withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col("_v")))).drop("_cuts")
    sizes = counted.groupBy(*keys, "_b").agg(F.sum("_m").alias("_bm"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # at most `pieces` rows a key
    offsets = sizes.select(*keys, "_b", F.coalesce(F.sum("_bm").over(before), F.lit(0)).alias("_off"))
    within = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = counted.join(offsets, [*keys, "_b"]).withColumn("_end", F.col("_off") + F.sum("_m").over(within))
    has = lambda rank: (rank >= F.col("_end") - F.col("_m")) & (rank < F.col("_end"))
    out = []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        low, high = F.max(F.when(has(lo), F.col("_v"))), F.max(F.when(has(hi), F.col("_v")))
        weight = F.max(hi - pos)
        out.append(F.when(weight == F.lit(0.0), low).otherwise(weight * low + (1.0 - weight) * high).alias(f"_q{i}"))
    return r.groupBy(*keys).agg(*out)
