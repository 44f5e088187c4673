"""Positions and ranks in one global order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barspark.session import materialize

_ROW_BITS = 33  # of a monotonically increasing id; the partition stands above


def positions(df: DataFrame, order: Column, name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: the row's place from 0 in the order of ``order``, and ``_part``, its range.

    Rows are dealt by ranges of the order (sampled by Spark, so that
    ranges hold alike many rows however narrow their values) and sorted within; a range's offset is the size of
    all ranges before it.  The offsets' window holds one row per range, not per row of ``df``.  Rows of equal
    order lie in one range, in any order."""
    dealt = df.repartitionByRange(partitions, order) if partitions else df.repartitionByRange(order)
    rows = materialize(dealt.sortWithinPartitions(order).withColumn("_id", F.monotonically_increasing_id()), "positions")
    rows = rows.withColumns({"_part": F.shiftright("_id", _ROW_BITS), "_row": F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)})
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset"))
    return rows.join(offsets, "_part").withColumn(name, F.col("_offset") + F.col("_row")).drop("_id", "_row", "_offset")


def ranks(df: DataFrame, order: Column, values: list[str], name: str, partitions: int | None = None) -> DataFrame:
    """SQL's RANK from 1: rows that agree in ``values`` (the columns of ``order``, null equal to null) share the lowest position."""
    at = positions(df, order, "_pos", partitions)
    first = at.groupBy(*[F.col(v).alias(f"_same_{v}") for v in values]).agg((F.min("_pos") + 1).alias(name))
    same = [F.col(v).eqNullSafe(F.col(f"_same_{v}")) for v in values]
    return at.join(first, same).drop("_pos", "_part", *[f"_same_{v}" for v in values])
