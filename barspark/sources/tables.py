"""Reading the driver-generated parquet tables with explicit column pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read ``{sf_dir}/{name}.parquet``; select ``cols`` so the scan's ReadSchema is pruned."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df
