"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.session import materialize

__all__ = ["SPACE", "UPPER", "LOWER", "let", "lower_ascii", "words", "word_count", "table", "ordered_index",
           "materialize", "batches"]

# The white space that separates words: U+0020 and U+0009 to U+000D, nothing else.
SPACE = r"\x20\x09-\x0D"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of a table, and nothing else (extra columns never clash)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Words of a text, in order; a null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+"), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")


def ordered_index(df: DataFrame, *order: Column, name: str = "idx", partitions: int | None = None) -> DataFrame:
    """Number the rows 0..n-1 in the given order without gathering them in one task.

    Rows are range-partitioned and sorted; a row's number is its place in
    its partition plus the sizes of the partitions before it.  The only
    global step is over one row per partition.  The numbered rows are
    written once, so that retried tasks cannot change the numbers; pass
    narrow rows.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .select("*", F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND((1 << 33) - 1).alias("_seq"))
        .drop("_at"), "ordered")
    sizes = part.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = (sizes.alias("a").join(sizes.alias("b"), F.col("b._part") < F.col("a._part"), "left")
              .groupBy("a._part").agg(F.coalesce(F.sum("b._n"), F.lit(0)).alias("_before")))
    return (part.join(before, "_part")
            .withColumn(name, F.col("_before") + F.col("_seq")).drop("_part", "_seq", "_before"))


def batches(it, rows: int):
    """Cut Arrow batches into pieces of at most ``rows`` rows."""
    for b in it:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
