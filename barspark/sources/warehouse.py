"""The warehouse: dimension seed, fact load with replace-by-symbol, scans, exports.

The fact table is parquet partitioned by (grain, symbol).  Loading a batch
replaces exactly the (grain, symbol) partitions present in the batch, in one
transaction (``versions.py``) -- the reference's "delete the symbol's rows,
then insert" -- so a re-run is idempotent, a load that fails changes nothing, and
a daily load never erases the intraday history of the same symbol or the
other way round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barspark.schemas import DIM, FACT_COLUMNS, FACT_DEFAULTS, VENDOR_COLUMN_MAP
from barspark.sources.bars import file_stem
from barspark.sources.versions import VersionedTable

# The reference's five-company seed of the dimension table.
SEED_DIM_ROWS = [
    ("AAPL", "Apple Inc.", "Technology", "Consumer Electronics", "NASDAQ"),
    ("MSFT", "Microsoft Corporation", "Technology", "Software - Infrastructure", "NASDAQ"),
    ("TSLA", "Tesla, Inc.", "Consumer Cyclical", "Auto Manufacturers", "NASDAQ"),
    ("RELIANCE.NS", "Reliance Industries Limited", "Energy", "Oil & Gas Refining & Marketing", "NSE"),
    ("TCS.NS", "Tata Consultancy Services Limited", "Technology", "Information Technology Services", "NSE"),
]


def seed_dim(spark: SparkSession, path: str, rows: list[tuple] | DataFrame | None = None) -> DataFrame:
    """Replace the whole dimension table (the facts are never touched)."""
    df = rows if isinstance(rows, DataFrame) else spark.createDataFrame(rows or SEED_DIM_ROWS, DIM)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def map_columns(df: DataFrame) -> DataFrame:
    """Vendor/processed column names -> fact columns: keep the mapped columns that
    are present (the first source wins when two map to one target), absent
    flags take FALSE, other absent columns NULL; unmapped columns are dropped."""
    present = {}
    for src, dst in VENDOR_COLUMN_MAP.items():
        if src in df.columns and dst not in present:
            present[dst] = F.col(f"`{src}`")
    cols: list[Column] = []
    for name, dtype in FACT_COLUMNS:
        if name in present:
            cols.append(present[name].cast(dtype).alias(name))
        elif name in FACT_DEFAULTS:
            cols.append(F.lit(FACT_DEFAULTS[name]).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*cols)


FACT_PARTITIONS = ["grain", "symbol"]


def fact_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, FACT_PARTITIONS)


def write_facts(fact: DataFrame, path: str, spread: int | None = None) -> None:
    """Replace-by-(grain, symbol) load in one transaction: only partitions present in ``fact`` change, all at once.

    Rows of a (grain, symbol) are dealt by year and month of ``ts`` too, so
    a hot symbol is written by many tasks, one file each.  With ``from_end`` the newest bars come first in a file."""
    n = spread or int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = fact.repartition(n, *FACT_PARTITIONS, F.date_trunc("month", F.col("ts")))
    if "from_end" in fact.columns:
        rows = rows.sortWithinPartitions(*FACT_PARTITIONS, "from_end")
    fact_table(fact.sparkSession, path).replace(rows)


def load_symbol(spark: SparkSession, path: str, symbol: str, grain: str = "1d",
                columns: list[str] | None = None) -> DataFrame:
    """One symbol's facts in time order; only its own folder is listed and read."""
    df = fact_table(spark, path).read(grain=grain, symbol=symbol)
    if columns:
        df = df.select(*columns)
    return df.orderBy("ts")


def export_csv(df: DataFrame, path: str) -> None:
    """Result export with a header row (one file per task, as Spark writes)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_name(label: str) -> str:
    """``<first word of the report label>_output.csv``."""
    return f"{label.split()[0]}_output.csv"


def write_per_symbol_csv(bars: DataFrame, path: str) -> None:
    """Per-symbol CSV layout: one folder per symbol (``symbol=<name>``)."""
    bars.write.mode("overwrite").option("header", True).partitionBy("symbol").csv(path)


def write_vendor_files(bars: DataFrame, path: str, suffix: str) -> None:
    """One CSV per symbol, named ``<stem>_<suffix>.csv`` (a folder of part files, as Spark writes a file).

    All symbols are written by one job, a symbol by as many tasks as it has
    months; the driver then renames one folder per symbol."""
    spark = bars.sparkSession
    bars.withColumn("_stem", file_stem(F.col("symbol"), suffix)).write.mode("overwrite").option("header", True).partitionBy("_stem").csv(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("_stem="):
            fs.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(folder, f"{name[6:]}.csv"))


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Stop the job when an input is empty (a cheap ``isEmpty`` probe)."""
    if df.isEmpty():
        raise RuntimeError(f"{what} is empty; run the load first")
    return df
