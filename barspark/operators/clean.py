"""Cleaning and data-quality operators over bar tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.functions.series import default_bucket, index_series

PRICE_COLUMNS = ["open", "high", "low", "close", "adj_close", "volume"]


def dedup_report(bars: DataFrame) -> DataFrame:
    """Rows in, rows kept and duplicates removed per symbol for the (symbol, ts) key."""
    per_key = bars.groupBy("symbol", "ts").agg(F.count(F.lit(1)).alias("_c"))
    return per_key.groupBy("symbol").agg(
        F.sum("_c").alias("rows_in"), F.count(F.lit(1)).alias("rows_out"),
        (F.sum("_c") - F.count(F.lit(1))).alias("duplicates_removed"))


def dedup_bars(bars: DataFrame, grain: str = "1d") -> DataFrame:
    """Keep the first row of every (symbol, ts) by (open, high, low, close, volume);
    done inside the distributed series index, which also numbers the rows."""
    d = index_series(bars, ["symbol"], "ts", default_bucket(grain),
                     tiebreak=["open", "high", "low", "close", "volume"], dedup=True)
    return d.drop("_idx", "_len")


def null_census(bars: DataFrame, columns: list[str] = PRICE_COLUMNS) -> DataFrame:
    """Null (or NaN) cells per symbol over the price columns, and their total."""
    def isnull(c):
        x = F.col(c)
        bad = x.isNull()
        if dict(bars.dtypes)[c] in ("double", "float"):
            bad = bad | F.isnan(x)
        return F.sum(F.when(bad, 1).otherwise(0)).alias(f"null_{c}")
    per = bars.groupBy("symbol").agg(*[isnull(c) for c in columns])
    return per.withColumn("null_total", sum(F.col(f"null_{c}") for c in columns))


def fill_prices(bars: DataFrame, grain: str = "1d", columns: list[str] = PRICE_COLUMNS) -> DataFrame:
    """Forward fill, then back fill leading nulls, each price column per symbol."""
    d = index_series(bars, ["symbol"], "ts", default_bucket(grain), dedup=False, fill=columns)
    return d.drop("_idx", "_len")


def local_date(ts_utc, tz: str):
    """Exchange-local calendar date of a UTC instant."""
    return F.to_date(F.from_utc_timestamp(ts_utc, tz))


def dq_checks(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """The star schema's constraints as checks: NOT NULL columns, UNIQUE(date, symbol)
    per grain, the foreign key to the dimension, the dimension's key.  One row per
    check with its violation count."""
    not_null = ["date", "symbol", "open", "high", "low", "close", "volume"]
    nn = fact.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
    nn_long = nn.select(F.explode(F.array(*[
        F.struct(F.lit(f"not_null_{c}").alias("check_name"), F.col(c).cast("long").alias("violations"))
        for c in not_null])).alias("s")).select("s.*")
    dup = (fact.groupBy("grain", "symbol", "date").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
           .agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("violations"))
           .select(F.lit("unique_date_symbol").alias("check_name"), "violations"))
    orphan = (fact.select("symbol").join(dim.select("symbol"), "symbol", "left_anti")
              .agg(F.count(F.lit(1)).alias("violations"))
              .select(F.lit("fk_symbol").alias("check_name"), "violations"))
    pk = (dim.groupBy("symbol").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
          .agg(F.count(F.lit(1)).alias("violations"))
          .select(F.lit("pk_dim_symbol").alias("check_name"), "violations"))
    ohlc = fact.agg(F.count_if((F.col("low") > F.least("open", "close")) |
                               (F.col("high") < F.greatest("open", "close"))).alias("violations")
                    ).select(F.lit("low_le_open_close_le_high").alias("check_name"), "violations")
    return nn_long.unionByName(dup).unionByName(orphan).unionByName(pk).unionByName(ohlc)
