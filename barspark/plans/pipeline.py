"""The ETL: driver tables -> bars -> features, materialized once per session.

Like the reference's fact table, the feature table is built once and every
report reads it; here it is a parquet table under the shared checkpoint
folder.  ``fact`` adds ``seq`` (bar number in its symbol, from 0), ``n_bars``
and ``from_end`` (0 at the last bar) so reports can address "the last bar", "the last 252
bars" etc. without a per-symbol sort.  Its files are sorted by ``from_end``: a
filter on it leaves all row groups and pages of older bars unread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from barspark.operators.features import features
from barspark.session import materialize
from barspark.sources.bars import bars_daily, bars_intraday, dim_from_nation

_MEMO: dict[tuple, DataFrame] = {}


def _memo(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def bars(spark: SparkSession, sf_dir: str, grain: str = "1d") -> DataFrame:
    """Materialized bars: '1d' from line items, '1h'/'1m' from events."""
    def build():
        b = bars_daily(spark, sf_dir) if grain == "1d" else bars_intraday(spark, sf_dir, grain)
        return materialize(b, f"bars_{grain}")
    return _memo(spark, sf_dir, f"bars_{grain}", build)


def fact(spark: SparkSession, sf_dir: str, grain: str = "1d") -> DataFrame:
    """Materialized FEATURE table plus ``seq``/``n_bars``/``from_end``, newest bars first in every file."""
    def build():
        f = features(bars(spark, sf_dir, grain), grain, keep_index=True)
        return materialize(f.sortWithinPartitions("from_end"), f"fact_{grain}")
    return _memo(spark, sf_dir, f"fact_{grain}", build)


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Materialized closes of every symbol on every trading date (``eda.calendar_fill``)."""
    from barspark.operators.eda import calendar_fill
    return _memo(spark, sf_dir, "calendar", lambda: materialize(calendar_fill(fact(spark, sf_dir)), "calendar"))


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_from_nation(spark, sf_dir)


def clear() -> None:
    _MEMO.clear()


def run_etl(spark: SparkSession, paths: list[str] | str, warehouse: str, grain: str = "1d",
            dim_rows: DataFrame | None = None) -> DataFrame:
    """The reference's ETL as one job graph: vendor bar files of all symbols ->
    dedup, fills, features, outlier flags -> fact table replaced by (grain,
    symbol) under ``warehouse``/fact; the dimension is written to
    ``warehouse``/dim when given.  Rows that cannot be read stand with their reasons in
    ``warehouse``/landed_<grain> (``rejected=true``), replaced by each run.  Returns the loaded fact table."""
    from barspark.sources.bars import split_vendor_bars
    from barspark.sources.warehouse import fact_table, require_rows, seed_dim, write_facts
    bars, _ = split_vendor_bars(spark, paths, f"{warehouse.rstrip('/')}/landed_{grain}", grain)
    fact_df = features(require_rows(bars, "bar files"), grain, keep_index=True)
    write_facts(fact_df, f"{warehouse.rstrip('/')}/fact")
    if dim_rows is not None:
        seed_dim(spark, f"{warehouse.rstrip('/')}/dim", dim_rows)
    return fact_table(spark, f"{warehouse.rstrip('/')}/fact").read()
