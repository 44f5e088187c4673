"""Technical indicators with any windows over any price column.

Same plan as ``features``: the series index (one shuffle by symbol x time
bucket, with dedup and fills), halo blocks, bounded windows and block scans
for the recurrences.  Rules as in ``features``: moving averages and bands
are null until their window is full, EMAs start from the first value, the RSI
is 50 before its window is full and where the smoothed loss is 0, and null
for symbols shorter than its window.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.functions.scan import Scan, ewm_term, loc, max_block, scan_blocks, scan_finish, scan_locals
from barspark.functions.series import block_window, blocked, default_bucket, index_series, rolling
from barspark.operators.features import span_alpha
from barspark.session import materialize

KEYS = ["symbol"]


@dataclass(frozen=True)
class Windows:
    """Windows of each indicator; an empty tuple or None leaves the indicator out."""
    sma: tuple[int, ...] = (20, 50)
    ema: tuple[int, ...] = (20,)
    rsi: int | None = 14
    macd: tuple[int, int, int] | None = (12, 26, 9)
    bollinger: tuple[int, float] | None = (20, 2.0)


def _scans(w: Windows) -> list[Scan]:
    first, x = F.col("_idx") == 0, F.col("_x")
    out = [Scan(f"ema_{n}", ewm_term(x, span_alpha(n), first), 1 - span_alpha(n)) for n in w.ema]
    if w.rsi:
        a = 1.0 / w.rsi

        def smoothed(v):
            return F.when(F.col("_idx") == 1, v).when(F.col("_idx") >= 2, F.lit(a) * v).otherwise(F.lit(0.0))

        d = F.coalesce(F.col("_x") - F.col("_before"), F.lit(0.0))
        out += [Scan("_gain", smoothed(F.greatest(d, F.lit(0.0))), 1 - a), Scan("_loss", smoothed(F.greatest(-d, F.lit(0.0))), 1 - a)]
    if w.macd:
        fast, slow, signal = map(span_alpha, w.macd)
        out += [Scan("_fast", ewm_term(x, fast, first), 1 - fast), Scan("_slow", ewm_term(x, slow, first), 1 - slow),
                Scan("macd_signal", ewm_term(loc("_fast") - loc("_slow"), signal, first), 1 - signal,
                     feed={"_fast": signal, "_slow": -signal})]
    return out


def enrich(bars: DataFrame, grain: str = "1d", column: str = "close", windows: Windows = Windows()) -> DataFrame:
    """``bars`` (deduplicated, the column filled) with ``sma_<n>``, ``ema_<n>``, ``rsi_<n>``, ``macd_line``,
    ``macd_signal``, ``macd_hist`` and ``bb_middle``, ``bb_upper``, ``bb_lower``, ``bb_bandwidth`` of one column."""
    w = windows
    scans = _scans(w)
    block = max_block([s.r for s in scans])
    halo = max([1, *w.sma, *([w.bollinger[0]] if w.bollinger else [])])
    if halo > block:
        raise ValueError(f"a window of {halo} bars does not fit the block of {block} bars that the shortest span allows; "
                         "ask for the two in separate calls")
    d = index_series(bars, KEYS, "ts", default_bucket(grain), tiebreak=["open", "high", "low", "close", "volume"], fill=[column])
    d = blocked(d.withColumn("_x", F.col(column).cast("double")), KEYS, back=halo, block=block)
    d = d.withColumn("_before", F.lag("_x").over(block_window(KEYS)))
    d = d.withColumns({f"sma_{n}": rolling(F.avg, "_x", n, KEYS) for n in w.sma})
    if w.bollinger:
        n, k = w.bollinger
        mid, sd = rolling(F.avg, "_x", n, KEYS), rolling(F.stddev_samp, "_x", n, KEYS)
        d = d.withColumns({"bb_middle": mid, "bb_upper": mid + F.lit(float(k)) * sd, "bb_lower": mid - F.lit(float(k)) * sd})
        d = d.withColumn("bb_bandwidth", F.try_divide(F.col("bb_upper") - F.col("bb_lower"), F.col("bb_middle")))
    m = materialize(scan_locals(d, KEYS, scans, block).filter("_own"), "enrich_stage")
    out = scan_finish(m.join(scan_blocks(m, KEYS, scans, block), [*KEYS, "_blk"]), scans)
    new = [f"sma_{n}" for n in w.sma] + [f"ema_{n}" for n in w.ema]
    if w.rsi:
        rsi = 100 - 100 / (1 + F.try_divide(F.col("_gain"), F.col("_loss")))
        rsi = F.coalesce(F.when(F.col("_idx") >= w.rsi, rsi), F.lit(50.0))
        out = out.withColumn(f"rsi_{w.rsi}", F.when(F.col("_len") >= w.rsi, rsi))
        new.append(f"rsi_{w.rsi}")
    if w.macd:
        line = F.col("_fast") - F.col("_slow")
        out = out.withColumns({"macd_line": line, "macd_hist": line - F.col("macd_signal")})
        new += ["macd_line", "macd_signal", "macd_hist"]
    if w.bollinger:
        new += ["bb_middle", "bb_upper", "bb_lower", "bb_bandwidth"]
    return out.select(*bars.columns, *new)


def sma(bars: DataFrame, window: int = 20, column: str = "close", grain: str = "1d") -> DataFrame:
    return enrich(bars, grain, column, Windows((window,), (window,), None, None, None)).drop(f"ema_{window}")


def ema(bars: DataFrame, window: int = 20, column: str = "close", grain: str = "1d") -> DataFrame:
    return enrich(bars, grain, column, Windows((), (window,), None, None, None))


def rsi(bars: DataFrame, window: int = 14, column: str = "close", grain: str = "1d") -> DataFrame:
    return enrich(bars, grain, column, Windows((), (), window, None, None))


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9, column: str = "close", grain: str = "1d") -> DataFrame:
    return enrich(bars, grain, column, Windows((), (), None, (fast, slow, signal), None))


def bollinger(bars: DataFrame, window: int = 20, deviations: float = 2.0, column: str = "close", grain: str = "1d") -> DataFrame:
    return enrich(bars, grain, column, Windows((), (window,), None, None, (window, deviations))).drop(f"ema_{window}")
