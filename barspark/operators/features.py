"""Returns, volatility, rolling statistics, technical indicators, IQR outlier flags.

``features(bars)`` turns bars of any number of symbols into the FEATURE
table in one plan: one shuffle to index the series (with dedup and fills),
one to block it, two small carry joins for the recurrences, one join with
the per-symbol quantiles.  Semantics follow the reference's pandas code:

* returns: ``close / prev - 1``; the first bar 0; a zero previous close gives
  null (pandas would give inf);
* daily volatility: sample std of the 20 last returns, computed before the
  first return is zero-filled, so the first value is on bar 21;
  intraday volatility: 5 returns after the fill, nulls become 0;
* SMA / rolling mean / std: null until the window is full;
* EMA: ``ewm(span, adjust=False)`` seeded with the first close;
* RSI(14): gains/losses smoothed with alpha 1/14 seeded with the first
  difference, valid from the 15th bar; a zero average loss gives 50; bars
  before validity are 50; a symbol with fewer than 14 bars gets null;
* MACD 12/26/9 and Bollinger 20/2 as usual, bandwidth null when middle is 0;
* outliers: strict ``<``/``>`` against Q1/Q3 -/+ 3 IQR per symbol (linear
  interpolation quantiles), never dropped; null compares false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barspark.functions.quantiles import exact_quantiles
from barspark.functions.scan import (Scan, ewm_term, loc, max_block, scan_blocks,
                                     scan_finish, scan_locals)
from barspark.functions.series import (block_window, blocked, default_bucket,
                                       index_series, rolling)
from barspark.schemas import FEATURE_COLUMNS
from barspark.session import materialize

KEYS = ["symbol"]
PRICE_COLUMNS = ["open", "high", "low", "close", "volume"]
HALO = 50          # the widest backward window (SMA 50) plus the return lag

# Fixed indicator parameters of the reference.
SMA_WINDOWS = (20, 50)
EMA_SPAN = 20
RSI_WINDOW = 14
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
BB_WINDOW, BB_STD = 20, 2.0
IQR_MULTIPLIER = 3.0


def span_alpha(span: int) -> float:
    return 2.0 / (span + 1)


def _ratios() -> list[float]:
    return [1 - span_alpha(s) for s in (EMA_SPAN, MACD_FAST, MACD_SLOW, MACD_SIGNAL)] + [1 - 1 / RSI_WINDOW]


FILL_COLUMNS = ["open", "high", "low", "close", "adj_close", "volume"]


def indexed(bars: DataFrame, grain: str) -> DataFrame:
    """Dedup (keep first by OHLCV) + fills + series index, one shuffle."""
    return index_series(bars, KEYS, "ts", default_bucket(grain),
                        tiebreak=["open", "high", "low", "close", "volume"], fill=FILL_COLUMNS)


def base_columns(d: DataFrame, grain: str) -> DataFrame:
    """Window-only columns on a blocked series (returns, rolling stats, SMA, BB)."""
    w = block_window(KEYS)
    d = d.withColumn("_prev", F.lag("close").over(w))
    r_raw = F.try_divide(F.col("close"), F.col("_prev")) - 1
    ret = F.when(F.col("_idx") == 0, F.lit(0.0)).otherwise(r_raw)
    mid = rolling(F.avg, "close", BB_WINDOW, KEYS)
    sd = rolling(F.stddev_samp, "close", BB_WINDOW, KEYS)
    upper, lower = mid + F.lit(BB_STD) * sd, mid - F.lit(BB_STD) * sd
    none = F.lit(None).cast("double")
    if grain == "1d":
        extra = {"volatility": rolling(F.stddev_samp, r_raw, 20, KEYS),
                 "close_rolling_mean_20": mid, "close_rolling_std_20": sd,
                 "volume_rolling_mean_20": rolling(F.avg, "volume", 20, KEYS)}
    else:
        extra = {"volatility": F.coalesce(rolling(F.stddev_samp, ret, 5, KEYS), F.lit(0.0)),
                 "close_rolling_mean_20": none, "close_rolling_std_20": none,
                 "volume_rolling_mean_20": none}
    return d.withColumns({
        "daily_return": ret, "pct_change": ret * 100,
        "_delta": F.col("close") - F.col("_prev"), **extra,
        "sma_20": rolling(F.avg, "close", SMA_WINDOWS[0], KEYS),
        "sma_50": rolling(F.avg, "close", SMA_WINDOWS[1], KEYS),
        "bb_middle": mid, "bb_upper": upper, "bb_lower": lower,
        "bb_bandwidth": F.try_divide(upper - lower, mid),
    }).drop("_prev")


def indicator_scans(price: str = "close") -> list[Scan]:
    """EMA 20, EMA 12/26 with the chained MACD signal, RSI gain/loss smoothing."""
    first = F.col("_idx") == 0
    x = F.col(price)
    a_rsi = 1.0 / RSI_WINDOW
    gain = F.when(F.col("_delta") > 0, F.col("_delta")).otherwise(F.lit(0.0))
    loss = F.when(F.col("_delta") < 0, -F.col("_delta")).otherwise(F.lit(0.0))

    def rsi_term(v: Column) -> Column:
        return (F.when(F.col("_idx") == 1, v)
                .when(F.col("_idx") >= 2, F.lit(a_rsi) * v).otherwise(F.lit(0.0)))

    a_sig = span_alpha(MACD_SIGNAL)
    line_loc = loc("_ema_fast") - loc("_ema_slow")
    return [
        Scan("ema_20", ewm_term(x, span_alpha(EMA_SPAN), first), 1 - span_alpha(EMA_SPAN)),
        Scan("_ema_fast", ewm_term(x, span_alpha(MACD_FAST), first), 1 - span_alpha(MACD_FAST)),
        Scan("_ema_slow", ewm_term(x, span_alpha(MACD_SLOW), first), 1 - span_alpha(MACD_SLOW)),
        Scan("_avg_gain", rsi_term(gain), 1 - a_rsi),
        Scan("_avg_loss", rsi_term(loss), 1 - a_rsi),
        Scan("macd_signal", ewm_term(line_loc, a_sig, first), 1 - a_sig,
             feed={"_ema_fast": a_sig, "_ema_slow": -a_sig}),
    ]


def indicator_columns(d: DataFrame) -> DataFrame:
    """MACD line/hist and RSI from the finished scans."""
    rs = F.try_divide(F.col("_avg_gain"), F.col("_avg_loss"))
    rsi = F.coalesce(F.when(F.col("_idx") >= RSI_WINDOW, 100 - 100 / (1 + rs)), F.lit(50.0))
    line = F.col("_ema_fast") - F.col("_ema_slow")
    return d.withColumns({
        "macd_line": line, "macd_hist": line - F.col("macd_signal"),
        "rsi_14": F.when(F.col("_len") >= RSI_WINDOW, rsi)})


def iqr_bounds(df: DataFrame, columns: list[str], multiplier: float = IQR_MULTIPLIER,
               keys: list[str] = KEYS, exact: bool = True, accuracy: int = 100000) -> DataFrame:
    """Per key, ``_lo_<c>``/``_hi_<c>`` = Q1 - k*IQR / Q3 + k*IQR of every column.

    Exact linear-interpolation quantiles (pandas' default), computed without
    holding a key in one task (``functions.quantiles``); ``exact=False`` uses
    ``percentile_approx``."""
    if exact:
        q = exact_quantiles(df, keys, columns, [0.25, 0.75])
        qs = {c: (F.col(f"{c}_q0"), F.col(f"{c}_q1")) for c in columns}
    else:
        q = df.groupBy(*keys).agg(*[F.percentile_approx(F.col(c).cast("double"), F.array(F.lit(0.25), F.lit(0.75)),
                                                        accuracy).alias(f"_q_{c}") for c in columns])
        qs = {c: (F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]) for c in columns}
    cols = []
    for c, (q1, q3) in qs.items():
        cols += [(q1 - multiplier * (q3 - q1)).alias(f"_lo_{c}"), (q3 + multiplier * (q3 - q1)).alias(f"_hi_{c}")]
    return q.select(*keys, *cols)


def outlier_flag(c: str) -> Column:
    v = F.col(c).cast("double")
    return F.coalesce((v < F.col(f"_lo_{c}")) | (v > F.col(f"_hi_{c}")), F.lit(False))


def flag_outliers(df: DataFrame, columns: dict[str, str], multiplier: float = IQR_MULTIPLIER,
                  keys: list[str] = KEYS, exact: bool = True) -> DataFrame:
    """Add a boolean flag per column (``{column: flag_name}``); rows are never dropped."""
    out = df.join(iqr_bounds(df, list(columns), multiplier, keys, exact), keys, "left")
    out = out.withColumns({name: outlier_flag(c) for c, name in columns.items()})
    return out.drop(*[f"_{p}_{c}" for c in columns for p in ("lo", "hi")])


def features(bars: DataFrame, grain: str = "1d", outliers: bool = True, exact_quantiles: bool = True,
             keep_index: bool = False, block: int | None = None) -> DataFrame:
    """BAR -> FEATURE for every symbol at once (one grain per call).

    Plan: index (one shuffle by symbol x time bucket) -> halo blocks (one
    shuffle by symbol x block) -> window columns and in-block scan terms ->
    owned rows materialized -> one small per-block table (scan carries and
    IQR bounds) -> one join back.
    """
    scans = indicator_scans()
    block = block or max_block([s.r for s in scans])
    if block < HALO:
        raise ValueError("block must hold the 50-bar halo")
    d = blocked(indexed(bars, grain), KEYS, back=HALO, block=block)
    d = scan_locals(base_columns(d, grain), KEYS, scans, block)
    m = materialize(d.filter("_own"), f"features_{grain}_stage")
    blocks = scan_blocks(m, KEYS, scans, block)
    flags = {"daily_return": "daily_return_outlier"}
    if grain == "1d":
        flags["volume"] = "volume_outlier"
    if outliers:
        blocks = blocks.join(iqr_bounds(m, list(flags), keys=KEYS, exact=exact_quantiles), KEYS, "left")
    out = indicator_columns(scan_finish(m.join(blocks, [*KEYS, "_blk"]), scans))
    out = out.withColumns({name: outlier_flag(c) if outliers else F.lit(False)
                           for c, name in flags.items()})
    if "volume_outlier" not in flags.values():
        out = out.withColumn("volume_outlier", F.lit(False))
    if keep_index:
        return out.select(*FEATURE_COLUMNS, F.col("_idx").alias("seq"), F.col("_len").alias("n_bars"),
                          (F.col("_len") - 1 - F.col("_idx")).alias("from_end"))
    return out.select(*FEATURE_COLUMNS)
