"""DuckDB SQL twins of the registered queries (the correctness oracle).

The building blocks mirror the Spark plans: bars from line items / events,
the dimension, and the FEATURE table, whose EMA-family columns come from
one recursive CTE stepping every symbol forward one bar at a time.
"""

from __future__ import annotations

EMA_SPAN, MACD_FAST, MACD_SLOW, MACD_SIGNAL, RSI_WINDOW = 20, 12, 26, 9, 14


def R(x: str, d: int = 4) -> str:
    """Round ties away from zero exactly like ``functions.scalar.round_half``."""
    return f"(trunc(({x})::DOUBLE * 1e{d} + sign(({x})::DOUBLE) * 0.5::DOUBLE) / 1e{d} + 0.0::DOUBLE)"


def _a(span: int) -> str:
    return f"(2.0::DOUBLE / {span + 1})"


def _ema(prev: str, x: str, span: int) -> str:
    return f"((1 - {_a(span)}) * {prev} + {_a(span)} * {x})"


_PRICE = "l_extendedprice / nullif(l_quantity, 0)"
_LINE_KEY = "row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)"

BARS_1D = f"""bars_1d AS MATERIALIZED (
  SELECT n_name AS symbol, '1d' AS grain, CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP) AS ts,
         CAST(l_shipdate AS DATE) AS date,
         arg_min({_PRICE}, {_LINE_KEY}) AS open, max({_PRICE}) AS high, min({_PRICE}) AS low,
         arg_max({_PRICE}, {_LINE_KEY}) AS close, CAST(NULL AS DOUBLE) AS adj_close,
         CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY n_name, CAST(l_shipdate AS DATE))"""

BARS_1H = """bars_1h AS MATERIALIZED (
  SELECT event_type AS symbol, '1h' AS grain, date_trunc('hour', ts) AS ts,
         CAST(date_trunc('hour', ts) AS DATE) AS date,
         arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, row(ts, event_id)) AS close,
         CAST(NULL AS DOUBLE) AS adj_close, count(*) AS volume
  FROM events GROUP BY event_type, date_trunc('hour', ts))"""

BARS_1M = """bars_1m AS MATERIALIZED (
  SELECT event_type AS symbol, '1m' AS grain, date_trunc('minute', ts) AS ts,
         CAST(date_trunc('minute', ts) AS DATE) AS date,
         arg_min(value, row(ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, row(ts, event_id)) AS close,
         CAST(NULL AS DOUBLE) AS adj_close, count(*) AS volume
  FROM events GROUP BY event_type, date_trunc('minute', ts))"""

DIM = """dim AS (
  SELECT n_name AS symbol, n_name AS company_name, r_name AS sector,
         CAST(NULL AS VARCHAR) AS industry, CAST(NULL AS VARCHAR) AS exchange
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def feature_ctes(grain: str = "1d") -> str:
    """CTEs ending in ``feat_<grain>``: FEATURE columns + seq + n_bars."""
    src = "bars_1d" if grain == "1d" else "bars_1h"
    bars = BARS_1D if grain == "1d" else BARS_1H
    g = grain[1:]
    w = "PARTITION BY symbol ORDER BY seq ROWS BETWEEN {n} PRECEDING AND CURRENT ROW"
    def full(agg, col, n):
        return f"CASE WHEN count({col}) OVER ({w.format(n=n - 1)}) = {n} THEN {agg}({col}) OVER ({w.format(n=n - 1)}) END"
    fast_new = _ema("r.ema_fast", "b.close", MACD_FAST)
    slow_new = _ema("r.ema_slow", "b.close", MACD_SLOW)
    a_rsi = f"(1.0::DOUBLE / {RSI_WINDOW})"
    def smooth(prev, x):
        return f"CASE WHEN b.seq = 1 THEN {x} ELSE (1 - {a_rsi}) * {prev} + {a_rsi} * {x} END"
    gain = "greatest(b.close - b.prev_close, 0)"
    loss = "greatest(b.prev_close - b.close, 0)"
    if grain == "1d":
        vol = full("stddev_samp", "r_raw", 20)
        roll = (f"{full('avg', 'close', 20)} AS close_rolling_mean_20, "
                f"{full('stddev_samp', 'close', 20)} AS close_rolling_std_20, "
                f"{full('avg', 'volume', 20)} AS volume_rolling_mean_20")
    else:
        vol = f"coalesce({full('stddev_samp', 'daily_return', 5)}, 0.0)"
        roll = ("CAST(NULL AS DOUBLE) AS close_rolling_mean_20, CAST(NULL AS DOUBLE) AS close_rolling_std_20, "
                "CAST(NULL AS DOUBLE) AS volume_rolling_mean_20")
    vflag = ("coalesce(f.volume::DOUBLE < q.vq1 - 3.0::DOUBLE * (q.vq3 - q.vq1) OR "
             "f.volume::DOUBLE > q.vq3 + 3.0::DOUBLE * (q.vq3 - q.vq1), false)") if grain == "1d" else "false"
    return f"""{bars},
fb_{g} AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts) - 1 AS seq,
         count(*) OVER (PARTITION BY symbol) AS n_bars,
         lag(close) OVER (PARTITION BY symbol ORDER BY ts) AS prev_close
  FROM {src}),
rec_{g} AS (
  SELECT symbol, seq, close AS ema_20, close AS ema_fast, close AS ema_slow,
         0.0::DOUBLE AS macd_signal, 0.0::DOUBLE AS avg_gain, 0.0::DOUBLE AS avg_loss
  FROM fb_{g} WHERE seq = 0
  UNION ALL
  SELECT b.symbol, b.seq, {_ema('r.ema_20', 'b.close', EMA_SPAN)}, {fast_new}, {slow_new},
         {_ema('r.macd_signal', f'({fast_new} - {slow_new})', MACD_SIGNAL)},
         {smooth('r.avg_gain', gain)}, {smooth('r.avg_loss', loss)}
  FROM rec_{g} r JOIN fb_{g} b ON b.symbol = r.symbol AND b.seq = r.seq + 1),
fr_{g} AS (
  SELECT *, close / nullif(prev_close, 0) - 1 AS r_raw,
         CASE WHEN seq = 0 THEN 0.0 ELSE close / nullif(prev_close, 0) - 1 END AS daily_return
  FROM fb_{g}),
fw_{g} AS MATERIALIZED (
  SELECT symbol, grain, ts, date, open, high, low, close, adj_close, volume, seq, n_bars,
         daily_return, daily_return * 100 AS pct_change, {vol} AS volatility, {roll},
         {full('avg', 'close', 20)} AS sma_20, {full('avg', 'close', 50)} AS sma_50,
         {full('stddev_samp', 'close', 20)} AS sd_20
  FROM fr_{g}),
fq_{g} AS (
  SELECT symbol, quantile_cont(daily_return, 0.25) AS rq1, quantile_cont(daily_return, 0.75) AS rq3,
         quantile_cont(volume::DOUBLE, 0.25) AS vq1, quantile_cont(volume::DOUBLE, 0.75) AS vq3
  FROM fw_{g} GROUP BY symbol),
feat_{grain} AS MATERIALIZED (
  SELECT f.symbol, f.grain, f.ts, f.date, f.open, f.high, f.low, f.close, f.adj_close, f.volume,
         f.daily_return, f.pct_change, f.volatility, f.close_rolling_mean_20, f.close_rolling_std_20,
         f.volume_rolling_mean_20, f.sma_20, f.sma_50, r.ema_20,
         CASE WHEN f.n_bars < {RSI_WINDOW} THEN NULL
              WHEN f.seq >= {RSI_WINDOW} AND r.avg_loss <> 0 THEN 100 - 100 / (1 + r.avg_gain / r.avg_loss)
              ELSE 50.0 END AS rsi_14,
         r.ema_fast - r.ema_slow AS macd_line, r.macd_signal,
         (r.ema_fast - r.ema_slow) - r.macd_signal AS macd_hist,
         f.sma_20 + 2.0::DOUBLE * f.sd_20 AS bb_upper, f.sma_20 AS bb_middle,
         f.sma_20 - 2.0::DOUBLE * f.sd_20 AS bb_lower,
         ((f.sma_20 + 2.0::DOUBLE * f.sd_20) - (f.sma_20 - 2.0::DOUBLE * f.sd_20)) / nullif(f.sma_20, 0) AS bb_bandwidth,
         coalesce(f.daily_return < q.rq1 - 3.0::DOUBLE * (q.rq3 - q.rq1) OR
                  f.daily_return > q.rq3 + 3.0::DOUBLE * (q.rq3 - q.rq1), false) AS daily_return_outlier,
         {vflag} AS volume_outlier,
         f.seq, f.n_bars
  FROM fw_{g} f JOIN rec_{g} r USING (symbol, seq) JOIN fq_{g} q USING (symbol))"""


def with_features(select: str, grain: str = "1d", dim: bool = False) -> str:
    ctes = feature_ctes(grain) + (",\n" + DIM if dim else "")
    return f"WITH RECURSIVE {ctes}\n{select}"


def with_bars(select: str, grain: str = "1d", dim: bool = False) -> str:
    ctes = {"1d": BARS_1D, "1h": BARS_1H, "1m": BARS_1M}[grain] + (",\n" + DIM if dim else "")
    return f"WITH {ctes}\n{select}"
