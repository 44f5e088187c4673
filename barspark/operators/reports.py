"""The five warehouse reports (performance, month-over-month, SQL SMAs, RSI alerts,
top volume days), as DataFrame plans over the fact and dimension tables.

The dimension is joined on ``symbol``; Catalyst/AQE broadcast it when its
measured size allows, otherwise it is a shuffled join (the dimension grows
with the number of symbols, so no unconditional broadcast hint).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barspark.functions.scalar import round_half, rsi_signal
from barspark.functions.series import block_window, blocked


def perf_summary(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Per symbol: trading days, min/max/avg close (2 dp), avg volume (0 dp)."""
    agg = fact.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("total_trading_days"), F.min("close").alias("_min"),
        F.max("close").alias("_max"), F.avg("close").alias("_avg"), F.avg("volume").alias("_vol"))
    return (agg.join(dim, "symbol")
            .select("symbol", "company_name", "sector", "total_trading_days",
                    round_half("_min", 2).alias("min_price"), round_half("_max", 2).alias("max_price"),
                    round_half("_avg", 2).alias("avg_close_price"),
                    round_half("_vol", 0).alias("avg_daily_volume"))
            .orderBy("symbol"))


def mom_trend(fact: DataFrame) -> DataFrame:
    """Month-over-month change of the mean close; a symbol's first month is absent.

    The monthly table has one row per symbol-month, so the LAG window over
    it is small whatever the bar count."""
    monthly = fact.groupBy("symbol", F.date_format("date", "yyyy-MM").alias("year_month")).agg(
        F.avg("close").alias("avg_close"))
    w = Window.partitionBy("symbol").orderBy("year_month")
    prev = F.lag("avg_close").over(w)
    return (monthly.withColumn("_prev", prev).filter(F.col("_prev").isNotNull())
            .select("symbol", "year_month",
                    round_half("avg_close", 2).alias("current_month_avg_close"),
                    round_half("_prev", 2).alias("previous_month_avg_close"),
                    round_half(F.try_divide(F.col("avg_close") - F.col("_prev"), F.col("_prev")) * 100, 2)
                    .alias("mom_pct_change"))
            .orderBy("symbol", F.desc("year_month")))


def sma_sql(fact: DataFrame, limit: int | None = 100) -> DataFrame:
    """SMA 20/50 over *partial* frames (averages whatever is there from bar 1), the
    first ``limit`` rows by (symbol, date desc); ``limit=None`` keeps every row
    (a distributed sort instead of a top-k).

    The windows run on halo blocks of the ``seq`` numbering, so no symbol is
    sorted by a single task."""
    keys = ["symbol"]
    d = blocked(fact.select("symbol", "date", "close", F.col("seq").alias("_idx"),
                            F.col("n_bars").alias("_len")), keys, back=49)
    w = block_window(keys)
    out = (d.withColumns({
        "db_calculated_sma_20": round_half(F.avg("close").over(w.rowsBetween(-19, 0)), 2),
        "db_calculated_sma_50": round_half(F.avg("close").over(w.rowsBetween(-49, 0)), 2)})
        .filter("_own").select("date", "symbol", "close", "db_calculated_sma_20", "db_calculated_sma_50"))
    out = out.orderBy(F.col("symbol"), F.col("date").desc())
    return out if limit is None else out.limit(limit)


def rsi_alerts(fact: DataFrame, dim: DataFrame, limit: int | None = 50) -> DataFrame:
    """Bars with RSI >= 70 or <= 30, newest first (RSI desc, symbol as the final
    tie-break so the LIMIT is deterministic)."""
    hits = fact.filter((F.col("rsi_14") >= 70) | (F.col("rsi_14") <= 30))
    ordered = (hits.join(dim.select("symbol", "company_name"), "symbol")
               .orderBy(F.col("date").desc(), F.col("rsi_14").desc(), F.col("symbol")))
    if limit is not None:
        ordered = ordered.limit(limit)
    return (ordered
            .select("date", "company_name", "symbol", round_half("close", 2).alias("closing_price"),
                    round_half("rsi_14", 2).alias("rsi_14"), rsi_signal(F.col("rsi_14")).alias("signal_status"),
                    round_half("pct_change", 2).alias("daily_pct_change")))


def top_volume_days(fact: DataFrame, top: int = 5) -> DataFrame:
    """Days ranked by volume per (year, symbol) with DENSE_RANK <= ``top`` (ties keep
    more rows).  Catalyst plans a WindowGroupLimit below the window."""
    w = Window.partitionBy("trading_year", "symbol").orderBy(F.col("volume").desc())
    return (fact.select(F.date_format("date", "yyyy").alias("trading_year"), "date", "symbol", "volume", "close")
            .withColumn("volume_rank", F.dense_rank().over(w))
            .filter(F.col("volume_rank") <= top)
            .select("trading_year", "date", "symbol", "volume",
                    round_half("close", 2).alias("closing_price"), "volume_rank")
            .orderBy(F.desc("trading_year"), "symbol", "volume_rank", "date"))
