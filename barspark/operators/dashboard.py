"""Numbers behind the dashboard: KPIs, 52-week range, state texts, range filter,
chart series, plus the README-only volume-spike and top-performer reports.

"Latest", "previous", "last 252 bars" and "the 365th bar from the end" are
addressed through the fact table's ``from_end`` (by which its files are sorted, so
that the filter reaches the scan), i.e. plain filters and per-symbol
aggregates -- no per-symbol sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.functions.scalar import money, round_half, rsi_signal, shares, signed
from barspark.functions.ranking import ranks

# The dashboard's 52-week window (in bars), default range (bars
# from the end) and state labels.
TRADING_DAYS_YEAR = 252
DEFAULT_RANGE_BARS = 365
VOLUME_STATES = ("ANOMALOUS", "NORMAL")
SMA_STATES = ("BULLISH", "BEARISH")


def last_bars(fact: DataFrame, k: int) -> DataFrame:
    """The last ``k`` bars of every symbol; facts without ``from_end`` are asked for ``seq`` and ``n_bars``."""
    if "from_end" in fact.columns:
        return fact.filter(F.col("from_end") < k)
    return fact.filter(F.col("seq") >= F.col("n_bars") - k)


def latest(fact: DataFrame) -> DataFrame:
    """The last bar of every symbol."""
    return last_bars(fact, 1)


def latest_kpis(fact: DataFrame) -> DataFrame:
    """Close, change vs the previous bar, pct change, volume -- of the last bar."""
    two = last_bars(fact, 2)
    last = F.col("seq") == F.col("n_bars") - 1
    k = two.groupBy("symbol").agg(
        F.max(F.when(last, F.col("date"))).alias("date"),
        F.max(F.when(last, F.col("close"))).alias("close"),
        F.max(F.when(~last, F.col("close"))).alias("prev_close"),
        F.max(F.when(last, F.col("pct_change"))).alias("pct_change"),
        F.max(F.when(last, F.col("volume"))).alias("volume"))
    return k.select("symbol", "date", round_half("close").alias("close"),
                    round_half("prev_close").alias("prev_close"),
                    round_half(F.col("close") - F.col("prev_close")).alias("price_diff"),
                    round_half("pct_change").alias("pct_change"), "volume")


def high_low_52w(fact: DataFrame, bars: int = TRADING_DAYS_YEAR) -> DataFrame:
    """Max high / min low over the last ``bars`` rows (rows, not calendar days)."""
    return (last_bars(fact, bars).groupBy("symbol")
            .agg(round_half(F.max("high")).alias("high_52w"), round_half(F.min("low")).alias("low_52w")))


def volume_state(fact: DataFrame) -> DataFrame:
    """'ANOMALOUS' when the last bar's volume is flagged, else 'NORMAL'."""
    return latest(fact).select(
        "symbol", "date", "volume_outlier",
        F.when(F.col("volume_outlier"), F.lit(VOLUME_STATES[0])).otherwise(F.lit(VOLUME_STATES[1])).alias("volume_state"))


def range_filter(fact: DataFrame, start=None, end=None) -> DataFrame:
    """Bars with start <= date <= end (inclusive).  Defaults: end = last date, start =
    the date of the 365th bar from the end (the first bar for shorter series)."""
    if start is not None or end is not None:
        out = fact
        if start is not None:
            out = out.filter(F.col("date") >= F.lit(start))
        if end is not None:
            out = out.filter(F.col("date") <= F.lit(end))
        return out
    return last_bars(fact, DEFAULT_RANGE_BARS)


def rsi_regime(fact: DataFrame) -> DataFrame:
    """Regime of the last bar's RSI: overbought (>= 70), oversold (<= 30), balanced."""
    r = F.col("rsi_14")
    return latest(fact).select(
        "symbol", "date", round_half("rsi_14").alias("rsi_14"), rsi_signal(r).alias("rsi_signal"),
        F.when(r >= 70, F.lit("OVERBOUGHT")).when(r <= 30, F.lit("OVERSOLD"))
        .otherwise(F.lit("BALANCED")).alias("rsi_regime"))


def sma_state(fact: DataFrame) -> DataFrame:
    """Last close above its SMA 20 -> 'BULLISH', otherwise (also null SMA) 'BEARISH'."""
    above = F.coalesce(F.col("close") > F.col("sma_20"), F.lit(False))
    return latest(fact).select("symbol", "date", round_half("close").alias("close"),
                               round_half("sma_20").alias("sma_20"),
                               F.when(above, F.lit(SMA_STATES[0])).otherwise(F.lit(SMA_STATES[1])).alias("sma_state"))


def candle_flags(fact: DataFrame) -> DataFrame:
    """Per bar: rising candle (close > open) and positive MACD histogram."""
    return fact.select("symbol", "date", (F.col("close") > F.col("open")).alias("rising_candle"),
                       (F.col("macd_hist") > 0).alias("macd_hist_positive"))


def price_label(fact: DataFrame) -> DataFrame:
    """KPI texts of the last bar: price with currency sign, signed change, volume."""
    two = last_bars(fact, 2)
    last = F.col("seq") == F.col("n_bars") - 1
    k = two.groupBy("symbol").agg(
        F.max(F.when(last, F.col("close"))).alias("close"),
        F.max(F.when(~last, F.col("close"))).alias("prev_close"),
        F.max(F.when(last, F.col("pct_change"))).alias("pct_change"),
        F.max(F.when(last, F.col("volume"))).alias("volume"))
    sym = F.col("symbol")
    return k.select(
        "symbol", money(sym, F.col("close")).alias("price_text"),
        F.concat(signed(F.col("close") - F.col("prev_close")), F.lit(" ("),
                 signed(F.col("pct_change")), F.lit("%)")).alias("delta_text"),
        shares(F.col("volume")).alias("volume_text"))


CHART_COLUMNS = ["open", "high", "low", "close", "volume", "sma_20", "sma_50", "ema_20",
                 "bb_upper", "bb_middle", "bb_lower", "rsi_14", "macd_line", "macd_signal", "macd_hist"]


def chart_series(fact: DataFrame, overlays: list[str] | None = None) -> DataFrame:
    """OHLC + overlays + oscillators over the default range."""
    cols = overlays or CHART_COLUMNS
    return range_filter(fact).select(
        "symbol", "date", *[(F.col(c) if c == "volume" else round_half(c)).alias(c) for c in cols])


def profile(dim: DataFrame, symbol: str) -> DataFrame:
    """Company profile of one symbol from the dimension table."""
    return dim.filter(F.col("symbol") == F.lit(symbol))


def volume_spike(fact: DataFrame, k: float = 2.0) -> DataFrame:
    """Bars whose volume exceeds ``k`` times the mean volume of the last 20 bars
    (our definition of the README's 'volume spike detection')."""
    return (fact.filter(F.col("volume") > F.lit(k) * F.col("volume_rolling_mean_20"))
            .select("symbol", "date", "volume", round_half("volume_rolling_mean_20").alias("volume_rolling_mean_20"),
                    round_half(F.col("volume") / F.col("volume_rolling_mean_20")).alias("spike_ratio")))


def top_performers(fact: DataFrame) -> DataFrame:
    """Total return last close / first close - 1 per symbol, ranked (our definition
    of the README's 'top performing stocks').

    RANK semantics (ties share the lowest position, nulls last) from a range partitioning by
    descending return -- no single-partition window over the symbols."""
    ends = fact.filter((F.col("seq") == 0) | (F.col("seq") == F.col("n_bars") - 1)).groupBy("symbol").agg(
        F.max(F.when(F.col("seq") == 0, F.col("close"))).alias("first_close"),
        F.max(F.when(F.col("seq") == F.col("n_bars") - 1, F.col("close"))).alias("last_close"))
    tr = ends.withColumn("total_return", round_half(F.try_divide(F.col("last_close"), F.col("first_close")) - 1))
    ranked = ranks(tr, F.col("total_return").desc_nulls_last(), ["total_return"], "performance_rank")
    cols = ["symbol", round_half("first_close").alias("first_close"), round_half("last_close").alias("last_close"),
            "total_return", F.col("performance_rank").cast("long").alias("performance_rank")]
    return ranked.select(*cols)


def profiles(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Dimension rows of the symbols that have facts (left-semi join)."""
    return dim.join(fact.select("symbol"), "symbol", "left_semi")
