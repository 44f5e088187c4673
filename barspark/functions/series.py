"""Distributed ordered series without one task per key.

A window ``partitionBy('symbol')`` sends a whole symbol to one task; a
symbol holding a third of all bars would then be sorted by one core.  The
helpers here avoid that:

``index_series``  numbers the rows of every key 0..n-1 in time order.  Rows
    are windowed per (key, time bucket); a small table of per-bucket counts
    gives each bucket its offset.  It also drops duplicate (key, ts) rows,
    keeping the first by the tie-break, in the same pass.
``blocked``       cuts each key's series into blocks of ``block`` rows by
    index and copies the last ``back`` (first ``fwd``) rows of a block into
    the next (previous) one as non-owned halo rows.  Any window that looks at
    most ``back`` rows behind / ``fwd`` ahead then runs on
    ``Window.partitionBy(key, '_blk')`` with exact results, and a hot key is
    spread over ``n / block`` partitions.
``own_rows``      drops the halo and the helper columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024
HELPERS = ["_idx", "_len", "_blk", "_own", "_pos"]


def default_bucket(grain: str, ts: str = "ts") -> Column:
    """Time bucket that keeps a (key, bucket) group small for the bar grain."""
    c = F.col(ts)
    if grain in ("1d", "1wk", "1mo"):
        return F.year(c)
    if grain in ("1h", "4h"):
        return F.date_trunc("month", c)
    return F.date_trunc("day", c)


def index_series(df: DataFrame, keys: list[str], order: str, bucket: Column,
                 tiebreak: list[str] | None = None, dedup: bool = True,
                 fill: list[str] | None = None) -> DataFrame:
    """Add ``_idx`` (0-based rank of the row in its key by ``order``) and ``_len``.

    With ``dedup`` rows repeating (keys, order) are dropped, keeping the first
    by ``tiebreak`` (a deterministic keep-first, unlike ``dropDuplicates``).
    ``fill`` columns are forward-filled, then leading nulls back-filled, in
    the same pass: the per-bucket table also carries each bucket's last and
    first non-null value, so a gap spanning buckets is filled exactly.
    """
    fill = fill or []
    d = df.withColumn("_bkt", bucket)
    w = Window.partitionBy(*keys, "_bkt").orderBy(order, *(tiebreak or []))
    if dedup:
        d = (d.withColumn("_prev", F.lag(order).over(w))
             .filter(F.col("_prev").isNull() | (F.col("_prev") != F.col(order)))
             .drop("_prev"))
    aggs = [F.count(F.lit(1)).alias("_bn")]
    for c in fill:
        nn = F.when(F.col(c).isNotNull(), F.col(order))
        aggs += [F.max_by(c, nn).alias(f"_last_{c}"), F.min_by(c, nn).alias(f"_first_{c}")]
    counts = d.groupBy(*keys, "_bkt").agg(*aggs)
    wk = Window.partitionBy(*keys).orderBy("_bkt")
    before = wk.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys).orderBy("_bkt").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    cols = [*keys, "_bkt",
            F.coalesce(F.sum("_bn").over(before), F.lit(0)).alias("_off"),
            F.sum("_bn").over(Window.partitionBy(*keys)).alias("_len")]
    for c in fill:
        cols += [F.last(f"_last_{c}", ignorenulls=True).over(before).alias(f"_carry_{c}"),
                 F.first(f"_first_{c}", ignorenulls=True).over(whole).alias(f"_head_{c}")]
    offsets = counts.select(*cols)
    out = d.join(offsets, [*keys, "_bkt"]).withColumn(
        "_idx", F.col("_off") + F.row_number().over(w) - 1)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for c in fill:
        out = out.withColumn(c, F.coalesce(F.last(c, ignorenulls=True).over(upto),
                                           F.col(f"_carry_{c}"), F.col(f"_head_{c}")))
    return out.drop("_bkt", "_off", *[f"_{p}_{c}" for c in fill for p in ("carry", "head")])


def blocked(df: DataFrame, keys: list[str], back: int, fwd: int = 0,
            block: int = BLOCK) -> DataFrame:
    """Assign blocks of ``block`` rows plus halo copies; needs ``_idx``/``_len``."""
    if back > block or fwd > block:
        raise ValueError("halo wider than a block")
    idx = F.col("_idx")
    pos = idx % block
    blk = F.floor(idx / block).cast("long")
    shifts = F.array_compact(F.array(
        F.lit(0),
        F.when((pos >= block - back) & ((blk + 1) * block < F.col("_len")), F.lit(1)),
        F.when((pos < fwd) & (blk > 0), F.lit(-1))))
    return (df.withColumn("_sh", F.explode(shifts))
            .withColumn("_blk", blk + F.col("_sh"))
            .withColumn("_own", F.col("_sh") == 0)
            .withColumn("_pos", idx - F.col("_blk") * block)
            .drop("_sh"))


def block_window(keys: list[str]):
    return Window.partitionBy(*keys, "_blk").orderBy("_idx")


def own_rows(df: DataFrame) -> DataFrame:
    return df.filter("_own").drop(*[c for c in HELPERS if c in df.columns])


def rolling(agg, col: str | Column, n: int, keys: list[str]) -> Column:
    """Aggregate over the last ``n`` rows, null unless all ``n`` values are present
    (the full-window rule of a pandas ``rolling(n)``)."""
    c = F.col(col) if isinstance(col, str) else col
    w = block_window(keys).rowsBetween(-(n - 1), Window.currentRow)
    return F.when(F.count(c).over(w) == n, agg(c).over(w))
