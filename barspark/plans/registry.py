"""The query registry: name -> (Spark plan, DuckDB twin or None).

Every entry reads the driver tables (through the materialized bar/feature
tables of ``pipeline``) and returns a DataFrame whose computed columns are
aliased and rounded exactly like its SQL twin (``round_half`` / ``R``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barspark.functions.scalar import round_half
from barspark.operators import clean, dashboard, eda, forecast, indicators, portfolio, reports
from barspark.plans import pipeline as P
from barspark.plans.oracle import R, feature_ctes, with_bars, with_features
from barspark.schemas import FEATURE_COLUMNS, VENDOR_COLUMN_MAP

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _r(df: DataFrame, cols: list[str], d: int = 4) -> DataFrame:
    return df.withColumns({c: round_half(c, d) for c in cols})


def _sr(cols: list[str], d: int = 4, prefix: str = "") -> str:
    return ", ".join(f"{R(prefix + c, d)} AS {c}" for c in cols)


BAR_COLS = ["symbol", "grain", "ts", "date", "open", "high", "low", "close", "adj_close", "volume"]
BAR_DOUBLES = ["open", "high", "low", "close", "adj_close"]
FEATURE_DOUBLES = [c for c in FEATURE_COLUMNS if c not in BAR_COLS and not c.endswith("_outlier")]


def _fact(spark, sf, grain="1d"):
    return P.fact(spark, sf, grain)


# ------------------------------------------------------------------ bars and cleaning

@register("bars_daily", with_bars(f"SELECT {', '.join(c for c in BAR_COLS if c not in BAR_DOUBLES)}, "
                                  f"{_sr(BAR_DOUBLES)} FROM bars_1d"))
def q_bars_daily(spark, sf):
    return _r(P.bars(spark, sf, "1d"), BAR_DOUBLES).select(*BAR_COLS)


@register("bars_hourly", with_bars(f"SELECT {', '.join(c for c in BAR_COLS if c not in BAR_DOUBLES)}, "
                                   f"{_sr(BAR_DOUBLES)} FROM bars_1h", "1h"))
def q_bars_hourly(spark, sf):
    return _r(P.bars(spark, sf, "1h"), BAR_DOUBLES).select(*BAR_COLS)


@register("bars_minute", with_bars(f"SELECT {', '.join(c for c in BAR_COLS if c not in BAR_DOUBLES)}, "
                                   f"{_sr(BAR_DOUBLES)} FROM bars_1m", "1m"))
def q_bars_minute(spark, sf):
    from barspark.sources.bars import bars_intraday
    return _r(bars_intraday(spark, sf, "1m"), BAR_DOUBLES).select(*BAR_COLS)


# Bars with planted faults, by a rule on the bar's number of hours or days since 1970: missing prices and volumes,
# lows above highs, unknown symbols, and every fifth bar twice (the second time with a higher close).
def _faulty_sql(grain: str) -> str:
    unit, of = ("hour", "ts") if grain == "1h" else ("day", "date")
    start = "TIMESTAMP '1970-01-01'" if grain == "1h" else "DATE '1970-01-01'"
    return f"""(SELECT CASE WHEN d % 17 = 4 THEN 'NOWHERE' ELSE symbol END AS symbol, grain, ts, date,
  CASE WHEN d % 13 = 2 THEN NULL ELSE open END AS open, high, CASE WHEN d % 19 = 6 THEN high + 1 ELSE low END AS low,
  CASE WHEN d % 7 = 3 THEN NULL ELSE close + c END AS close, adj_close, CASE WHEN d % 11 = 5 THEN NULL ELSE volume END AS volume
  FROM (SELECT *, date_diff('{unit}', {start}, {of}) AS d FROM bars_{grain}) JOIN (SELECT unnest([0, 1]) AS c) ON c = 0 OR d % 5 = 0)"""


def _faulty(spark, sf, grain: str = "1h"):
    b = P.bars(spark, sf, grain)
    d = (F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ '1970-01-01', ts)") if grain == "1h"
         else F.datediff("date", F.lit("1970-01-01").cast("date")))
    b = b.withColumn("d", d.cast("long"))
    b = b.withColumn("c", F.explode(F.when(F.col("d") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    hole = lambda n, r, v: F.when(F.col("d") % n != r, v)
    return b.select(
        F.when(F.col("d") % 17 == 4, F.lit("NOWHERE")).otherwise(F.col("symbol")).alias("symbol"), "grain", "ts", "date",
        hole(13, 2, F.col("open")).alias("open"), "high",
        F.when(F.col("d") % 19 == 6, F.col("high") + 1).otherwise(F.col("low")).alias("low"),
        hole(7, 3, F.col("close") + F.col("c")).alias("close"), "adj_close", hole(11, 5, F.col("volume")).alias("volume"))


_KEPT = ("SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol, ts ORDER BY open NULLS FIRST, high NULLS FIRST, "
         "low NULLS FIRST, close NULLS FIRST, volume NULLS FIRST) AS n FROM {}) WHERE n = 1")


@register("dedup_bars", with_bars(
    f"SELECT symbol, ts, {_sr(['open', 'high', 'low', 'close'])}, volume FROM ({_KEPT.format(_faulty_sql('1h'))})", "1h"))
def q_dedup_bars(spark, sf):
    d = clean.dedup_bars(_faulty(spark, sf), "1h")
    return _r(d, ["open", "high", "low", "close"]).select("symbol", "ts", "open", "high", "low", "close", "volume")


@register("dedup_report", with_bars(
    "SELECT symbol, count(*) AS rows_in, count(DISTINCT ts) AS rows_out, "
    f"count(*) - count(DISTINCT ts) AS duplicates_removed FROM {_faulty_sql('1h')} GROUP BY symbol", "1h"))
def q_dedup_report(spark, sf):
    return clean.dedup_report(_faulty(spark, sf)).select(
        "symbol", F.col("rows_in").cast("long"), "rows_out", F.col("duplicates_removed").cast("long"))


@register("null_census", with_bars(
    "SELECT symbol, " + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_{c}" for c in clean.PRICE_COLUMNS)
    + ", CAST(" + " + ".join(f"count_if({c} IS NULL)" for c in clean.PRICE_COLUMNS)
    + f" AS BIGINT) AS null_total FROM {_faulty_sql('1d')} GROUP BY symbol"))
def q_null_census(spark, sf):
    df = clean.null_census(_faulty(spark, sf, "1d"))
    return df.select("symbol", *[F.col(c).cast("long") for c in df.columns if c != "symbol"])


def _filled_sql(c: str) -> str:
    w = "OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND"
    x = f"coalesce(last_value({c} IGNORE NULLS) {w} CURRENT ROW), first_value({c} IGNORE NULLS) {w} UNBOUNDED FOLLOWING))"
    return f"{x if c == 'volume' else R(x)} AS {c}"


@register("fill_prices", with_bars(
    f"SELECT symbol, ts, {', '.join(map(_filled_sql, clean.PRICE_COLUMNS))} FROM ({_KEPT.format(_faulty_sql('1h'))})", "1h"))
def q_fill_prices(spark, sf):
    d = clean.fill_prices(clean.dedup_bars(_faulty(spark, sf), "1h"), "1h")
    return _r(d, ["open", "high", "low", "close", "adj_close"]).select("symbol", "ts", *clean.PRICE_COLUMNS)


@register("dq_checks", with_bars(f""", faulty AS {_faulty_sql('1d')},
dim2 AS (SELECT symbol FROM dim UNION ALL SELECT symbol FROM dim WHERE symbol < 'NATION_2')
SELECT 'not_null_' || c AS check_name, v AS violations FROM (
  SELECT 'date' AS c, CAST(count_if(date IS NULL) AS BIGINT) AS v FROM faulty UNION ALL
  SELECT 'symbol', CAST(count_if(symbol IS NULL) AS BIGINT) FROM faulty UNION ALL
  SELECT 'open', CAST(count_if(open IS NULL) AS BIGINT) FROM faulty UNION ALL
  SELECT 'high', CAST(count_if(high IS NULL) AS BIGINT) FROM faulty UNION ALL
  SELECT 'low', CAST(count_if(low IS NULL) AS BIGINT) FROM faulty UNION ALL
  SELECT 'close', CAST(count_if(close IS NULL) AS BIGINT) FROM faulty UNION ALL
  SELECT 'volume', CAST(count_if(volume IS NULL) AS BIGINT) FROM faulty)
UNION ALL
SELECT 'unique_date_symbol', CAST(coalesce(sum(c - 1), 0) AS BIGINT) FROM
  (SELECT count(*) AS c FROM faulty GROUP BY grain, symbol, date HAVING count(*) > 1)
UNION ALL
SELECT 'fk_symbol', count(*) FROM faulty f WHERE NOT EXISTS (SELECT 1 FROM dim2 d WHERE d.symbol = f.symbol)
UNION ALL
SELECT 'pk_dim_symbol', count(*) FROM (SELECT symbol FROM dim2 GROUP BY symbol HAVING count(*) > 1)
UNION ALL
SELECT 'low_le_open_close_le_high', CAST(count_if(low > least(open, close) OR high < greatest(open, close)) AS BIGINT) FROM faulty
""", dim=True))
def q_dq_checks(spark, sf):
    d = P.dim(spark, sf)
    return clean.dq_checks(_faulty(spark, sf, "1d"), d.unionByName(d.filter("symbol < 'NATION_2'")))


# ------------------------------------------------------------------ features

_FEAT_KEYS = "symbol, grain, ts, date"


def _feat_query(cols: list[str], grain: str = "1d", keys: str = "symbol, date", d: int = 4):
    dbl = [c for c in cols if c in FEATURE_DOUBLES or c in BAR_DOUBLES]
    other = [c for c in cols if c not in dbl]
    sql = with_features(f"SELECT {keys}{', ' if other else ''}{', '.join(other)}, {_sr(dbl, d)} FROM feat_{grain}", grain)

    def run(spark, sf):
        f = _fact(spark, sf, grain)
        return _r(f, dbl, d).select(*[c.strip() for c in keys.split(",")], *other, *dbl)
    return run, sql


def _register_feat(name, cols, grain="1d", keys="symbol, date", d=4):
    fn, sql = _feat_query(cols, grain, keys, d)
    REGISTRY[name] = (fn, sql)


_register_feat("features_daily", [c for c in FEATURE_COLUMNS if c not in ("symbol", "grain", "ts", "date")],
               keys=_FEAT_KEYS)
_register_feat("features_hourly", [c for c in FEATURE_COLUMNS if c not in ("symbol", "grain", "ts", "date")],
               grain="1h", keys=_FEAT_KEYS)
_register_feat("returns", ["daily_return", "pct_change"], d=6)
_register_feat("volatility_20", ["volatility"], d=6)
_register_feat("volatility_5", ["volatility"], grain="1h", keys="symbol, ts", d=6)
_register_feat("rolling_stats_20", ["close_rolling_mean_20", "close_rolling_std_20", "volume_rolling_mean_20"])
_register_feat("sma", ["sma_20", "sma_50"])
_register_feat("ema_20", ["ema_20"])
_register_feat("rsi_14", ["rsi_14"])
_register_feat("macd", ["macd_line", "macd_signal", "macd_hist"])
_register_feat("bollinger", ["bb_upper", "bb_middle", "bb_lower", "bb_bandwidth"])
_register_feat("iqr_outliers", ["daily_return_outlier", "volume_outlier"])


@register("outlier_counts", with_features(
    "SELECT symbol, CAST(count_if(daily_return_outlier) AS BIGINT) AS return_outliers, "
    "CAST(count_if(volume_outlier) AS BIGINT) AS volume_outliers "
    "FROM feat_1d GROUP BY symbol"))
def q_outlier_counts(spark, sf):
    return _fact(spark, sf).groupBy("symbol").agg(
        F.count_if("daily_return_outlier").alias("return_outliers"), F.count_if("volume_outlier").alias("volume_outliers"))


# ------------------------------------------------------------------ the five reports

@register("perf_summary", with_features(f"""
SELECT s.symbol, s.company_name, s.sector, count(*) AS total_trading_days,
       {R('min(f.close)', 2)} AS min_price, {R('max(f.close)', 2)} AS max_price,
       {R('avg(f.close)', 2)} AS avg_close_price, {R('avg(f.volume)', 0)} AS avg_daily_volume
FROM feat_1d f JOIN dim s ON f.symbol = s.symbol
GROUP BY s.symbol, s.company_name, s.sector""", dim=True))
def q_perf_summary(spark, sf):
    return reports.perf_summary(_fact(spark, sf), P.dim(spark, sf))


@register("mom_trend", with_features(f"""
SELECT symbol, year_month, {R('avg_close', 2)} AS current_month_avg_close,
       {R('prev', 2)} AS previous_month_avg_close, {R('(avg_close - prev) / nullif(prev, 0) * 100', 2)} AS mom_pct_change
FROM (SELECT symbol, year_month, avg_close, lag(avg_close) OVER (PARTITION BY symbol ORDER BY year_month) AS prev
      FROM (SELECT symbol, strftime(date, '%Y-%m') AS year_month, avg(close) AS avg_close FROM feat_1d GROUP BY 1, 2))
WHERE prev IS NOT NULL"""))
def q_mom_trend(spark, sf):
    return reports.mom_trend(_fact(spark, sf))


@register("sma_sql", with_features(f"""
SELECT date, symbol, close,
       {R('avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)', 2)} AS db_calculated_sma_20,
       {R('avg(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 49 PRECEDING AND CURRENT ROW)', 2)} AS db_calculated_sma_50
FROM feat_1d ORDER BY symbol, date DESC LIMIT 100"""))
def q_sma_sql(spark, sf):
    return reports.sma_sql(_fact(spark, sf))


@register("rsi_alerts", with_features(f"""
SELECT f.date, s.company_name, f.symbol, {R('f.close', 2)} AS closing_price, {R('f.rsi_14', 2)} AS rsi_14,
       CASE WHEN f.rsi_14 >= 70 THEN 'OVERBOUGHT (SELL ALERT)' WHEN f.rsi_14 <= 30 THEN 'OVERSOLD (BUY OPPORTUNITY)'
            ELSE 'NEUTRAL' END AS signal_status,
       {R('f.pct_change', 2)} AS daily_pct_change
FROM feat_1d f JOIN dim s ON f.symbol = s.symbol
WHERE f.rsi_14 >= 70 OR f.rsi_14 <= 30
ORDER BY f.date DESC, f.rsi_14 DESC, f.symbol LIMIT 50""", dim=True))
def q_rsi_alerts(spark, sf):
    return reports.rsi_alerts(_fact(spark, sf), P.dim(spark, sf))


@register("top_volume_days", with_features(f"""
SELECT trading_year, date, symbol, volume, {R('close', 2)} AS closing_price, volume_rank FROM (
  SELECT strftime(date, '%Y') AS trading_year, date, symbol, volume, close,
         dense_rank() OVER (PARTITION BY strftime(date, '%Y'), symbol ORDER BY volume DESC) AS volume_rank
  FROM feat_1d) WHERE volume_rank <= 5"""))
def q_top_volume_days(spark, sf):
    return reports.top_volume_days(_fact(spark, sf)).withColumn("volume_rank", F.col("volume_rank").cast("long"))


# ------------------------------------------------------------------ exploratory statistics

_FILLED = """cal AS (SELECT s.symbol, d.date FROM (SELECT DISTINCT symbol FROM feat_1d) s
                 CROSS JOIN (SELECT DISTINCT date FROM feat_1d) d),
filled AS (SELECT symbol, date, coalesce(
    last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS close
  FROM cal LEFT JOIN feat_1d USING (symbol, date))"""


def _feat_plus(extra_ctes: str, select: str, dim: bool = False) -> str:
    base = with_features("", "1d", dim=dim).rstrip()
    return f"{base},\n{extra_ctes}\n{select}"


# The symbols of the daily bars: the given tables number their nations.
SYMBOLS = [f"NATION_{i}" for i in range(25)]


@register("close_pivot", with_features("SELECT date, " + ", ".join(
    f"max(CASE WHEN symbol = '{x}' THEN {R('close')} END) AS \"{x}\"" for x in SYMBOLS) + " FROM feat_1d GROUP BY date"))
def q_close_pivot(spark, sf):
    return eda.close_pivot(_fact(spark, sf), SYMBOLS)


@register("calendar_fill", _feat_plus(_FILLED, f"SELECT symbol, date, {R('close')} AS close FROM filled"))
def q_calendar_fill(spark, sf):
    return P.calendar(spark, sf).select("symbol", "date", round_half("close").alias("close"))


@register("rebased_growth", _feat_plus(_FILLED, f"""
SELECT symbol, date, {R("close / nullif(first_value(close) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) * 100")} AS rebased_close
FROM filled"""))
def q_rebased_growth(spark, sf):
    return eda.rebased_growth(_fact(spark, sf), P.calendar(spark, sf))


@register("price_corr", _feat_plus(_FILLED, f"""
SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, {R('corr(a.close, b.close)')} AS corr
FROM filled a JOIN filled b ON a.date = b.date GROUP BY a.symbol, b.symbol"""))
def q_price_corr(spark, sf):
    return eda.price_corr(_fact(spark, sf), P.calendar(spark, sf))


@register("clipped_returns", with_features(
    f"SELECT symbol, date, {R('daily_return', 6)} AS daily_return FROM feat_1d WHERE daily_return > -0.1 AND daily_return < 0.1"))
def q_clipped_returns(spark, sf):
    return eda.clipped_returns(_fact(spark, sf))


@register("return_box", _feat_plus("""r AS (SELECT symbol, daily_return AS x FROM feat_1d WHERE daily_return > -0.1 AND daily_return < 0.1),
q AS (SELECT symbol, count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median,
             quantile_cont(x, 0.75) AS q3 FROM r GROUP BY symbol),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)""", f"""
SELECT f.symbol, f.n, {R('f.q1', 6)} AS q1, {R('f.median', 6)} AS median, {R('f.q3', 6)} AS q3,
       {R('min(CASE WHEN r.x >= f.lo AND r.x <= f.hi THEN r.x END)', 6)} AS whisker_low,
       {R('max(CASE WHEN r.x >= f.lo AND r.x <= f.hi THEN r.x END)', 6)} AS whisker_high,
       CAST(count_if(NOT (r.x >= f.lo AND r.x <= f.hi)) AS BIGINT) AS outliers
FROM r JOIN f USING (symbol) GROUP BY f.symbol, f.n, f.q1, f.median, f.q3"""))
def q_return_box(spark, sf):
    return eda.return_box(_fact(spark, sf))


@register("avg_volume_millions", with_features(
    f"SELECT symbol, {R('avg(volume) / 1e6', 6)} AS volume_millions FROM feat_1d GROUP BY symbol"))
def q_avg_volume_millions(spark, sf):
    return eda.avg_volume_millions(_fact(spark, sf))


_SQRT_2PI = repr(__import__("math").sqrt(2 * __import__("math").pi))


@register("return_kde", _feat_plus(f"""grid AS (SELECT round(-0.08::DOUBLE + i * 0.001::DOUBLE, 6) AS x FROM range(161) t(i)),
bw AS (SELECT symbol, count(daily_return) AS n, stddev_samp(daily_return) * pow(count(daily_return)::DOUBLE, -0.2) AS h
       FROM feat_1d GROUP BY symbol)""", f"""
SELECT f.symbol, g.x, {R(f'sum(exp(-0.5 * ((g.x - f.daily_return) / bw.h) * ((g.x - f.daily_return) / bw.h))) / nullif(bw.n * bw.h * {_SQRT_2PI}::DOUBLE, 0)', 6)} AS density
FROM feat_1d f JOIN bw USING (symbol) CROSS JOIN grid g
WHERE f.daily_return IS NOT NULL GROUP BY f.symbol, g.x, bw.n, bw.h"""))
def q_return_kde(spark, sf):
    return eda.return_kde(_fact(spark, sf))


# ------------------------------------------------------------------ dashboard

_LAST = "seq = n_bars - 1"


@register("latest_kpis", with_features(f"""
SELECT symbol, max(CASE WHEN {_LAST} THEN date END) AS date,
       {R(f'max(CASE WHEN {_LAST} THEN close END)')} AS close,
       {R(f'max(CASE WHEN NOT ({_LAST}) THEN close END)')} AS prev_close,
       {R(f'max(CASE WHEN {_LAST} THEN close END) - max(CASE WHEN NOT ({_LAST}) THEN close END)')} AS price_diff,
       {R(f'max(CASE WHEN {_LAST} THEN pct_change END)')} AS pct_change,
       max(CASE WHEN {_LAST} THEN volume END) AS volume
FROM feat_1d WHERE seq >= n_bars - 2 GROUP BY symbol"""))
def q_latest_kpis(spark, sf):
    return dashboard.latest_kpis(_fact(spark, sf))


@register("high_low_52w", with_features(
    f"SELECT symbol, {R('max(high)')} AS high_52w, {R('min(low)')} AS low_52w FROM feat_1d WHERE seq >= n_bars - 252 GROUP BY symbol"))
def q_high_low_52w(spark, sf):
    return dashboard.high_low_52w(_fact(spark, sf))


@register("volume_state", with_features(
    f"SELECT symbol, date, volume_outlier, CASE WHEN volume_outlier THEN 'ANOMALOUS' ELSE 'NORMAL' END AS volume_state "
    f"FROM feat_1d WHERE {_LAST}"))
def q_volume_state(spark, sf):
    return dashboard.volume_state(_fact(spark, sf))


@register("range_filter", with_features(
    f"SELECT symbol, date, {R('close')} AS close FROM feat_1d WHERE seq >= greatest(n_bars - 365, 0)"))
def q_range_filter(spark, sf):
    return dashboard.range_filter(_fact(spark, sf)).select("symbol", "date", round_half("close").alias("close"))


@register("rsi_regime", with_features(f"""
SELECT symbol, date, {R('rsi_14')} AS rsi_14,
       CASE WHEN rsi_14 >= 70 THEN 'OVERBOUGHT (SELL ALERT)' WHEN rsi_14 <= 30 THEN 'OVERSOLD (BUY OPPORTUNITY)' ELSE 'NEUTRAL' END AS rsi_signal,
       CASE WHEN rsi_14 >= 70 THEN 'OVERBOUGHT' WHEN rsi_14 <= 30 THEN 'OVERSOLD' ELSE 'BALANCED' END AS rsi_regime
FROM feat_1d WHERE {_LAST}"""))
def q_rsi_regime(spark, sf):
    return dashboard.rsi_regime(_fact(spark, sf))


@register("sma_state", with_features(f"""
SELECT symbol, date, {R('close')} AS close, {R('sma_20')} AS sma_20,
       CASE WHEN coalesce(close > sma_20, false) THEN 'BULLISH' ELSE 'BEARISH' END AS sma_state
FROM feat_1d WHERE {_LAST}"""))
def q_sma_state(spark, sf):
    return dashboard.sma_state(_fact(spark, sf))


@register("candle_flags", with_features(
    "SELECT symbol, date, close > open AS rising_candle, macd_hist > 0 AS macd_hist_positive FROM feat_1d"))
def q_candle_flags(spark, sf):
    return dashboard.candle_flags(_fact(spark, sf))


# Every second symbol carries the suffix of an Indian listing, by a rule in both engines.
_LISTED_SQL = "CASE WHEN ascii(right(symbol, 1)) % 2 = 0 THEN symbol || '.NS' ELSE symbol END"


@register("price_label", with_features(f"""
SELECT symbol,
       (CASE WHEN contains(symbol, 'NS') THEN '₹' ELSE '$' END) || printf('%.2f', {R('c', 2)}) AS price_text,
       printf('%+.2f', {R('c - p', 2)}) || ' (' || printf('%+.2f', {R('pc', 2)}) || '%)' AS delta_text,
       format('{{:,}}', v) || ' shares' AS volume_text
FROM (SELECT {_LISTED_SQL} AS symbol, max(CASE WHEN {_LAST} THEN close END) AS c, max(CASE WHEN NOT ({_LAST}) THEN close END) AS p,
             max(CASE WHEN {_LAST} THEN pct_change END) AS pc, max(CASE WHEN {_LAST} THEN volume END) AS v
      FROM feat_1d WHERE seq >= n_bars - 2 GROUP BY 1)"""))
def q_price_label(spark, sf):
    return dashboard.price_label(_fact(spark, sf).withColumn("symbol", F.expr(_LISTED_SQL)))


@register("chart_series", with_features(
    "SELECT symbol, date, volume, " + ", ".join(f"{R(c)} AS {c}" for c in dashboard.CHART_COLUMNS if c != "volume")
    + " FROM feat_1d WHERE seq >= greatest(n_bars - 365, 0)"))
def q_chart_series(spark, sf):
    return dashboard.chart_series(_fact(spark, sf))


@register("company_profile", with_features(
    "SELECT * FROM dim WHERE symbol IN (SELECT symbol FROM feat_1d)", dim=True))
def q_company_profile(spark, sf):
    return dashboard.profiles(P.dim(spark, sf), _fact(spark, sf))


@register("volume_spike", with_features(f"""
SELECT symbol, date, volume, {R('volume_rolling_mean_20')} AS volume_rolling_mean_20,
       {R('volume / volume_rolling_mean_20')} AS spike_ratio
FROM feat_1d WHERE volume > 2.0::DOUBLE * volume_rolling_mean_20"""))
def q_volume_spike(spark, sf):
    return dashboard.volume_spike(_fact(spark, sf))


@register("top_performers", with_features(f"""
SELECT symbol, {R('f')} AS first_close, {R('l')} AS last_close, {R('l / nullif(f, 0) - 1')} AS total_return,
       rank() OVER (ORDER BY {R('l / nullif(f, 0) - 1')} DESC) AS performance_rank
FROM (SELECT symbol, max(CASE WHEN seq = 0 THEN close END) AS f, max(CASE WHEN {_LAST} THEN close END) AS l
      FROM feat_1d WHERE seq = 0 OR {_LAST} GROUP BY symbol)"""))
def q_top_performers(spark, sf):
    return dashboard.top_performers(_fact(spark, sf)).withColumn("performance_rank", F.col("performance_rank").cast("long"))


# ------------------------------------------------------------------ portfolio

_WEIGHTS = """w AS (SELECT r_name AS portfolio_id, n_name AS symbol,
    CAST(floor(100 / k) + CASE WHEN rn <= 100 - floor(100 / k) * k THEN 1 ELSE 0 END AS INTEGER) AS weight_pct
  FROM (SELECT r_name, n_name, row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS rn,
               count(*) OVER (PARTITION BY r_name) AS k
        FROM nation JOIN region ON n_regionkey = r_regionkey)),
px AS (SELECT w.portfolio_id, f.symbol, f.date, f.close, w.weight_pct FROM feat_1d f JOIN w USING (symbol)),
common AS (SELECT portfolio_id, date FROM px GROUP BY portfolio_id, date
           HAVING count(*) = (SELECT count(*) FROM w w2 WHERE w2.portfolio_id = px.portfolio_id)),
rets AS (SELECT portfolio_id, symbol, date, weight_pct / 100.0::DOUBLE AS weight, ret FROM (
           SELECT px.*, close / nullif(lag(close) OVER (PARTITION BY portfolio_id, symbol ORDER BY date), 0) - 1 AS ret
           FROM px JOIN common USING (portfolio_id, date)) WHERE ret IS NOT NULL)"""


def _weights(spark, sf):
    return portfolio.region_portfolios(spark, sf)


def _rets(spark, sf):
    return portfolio.aligned_returns(_fact(spark, sf), _weights(spark, sf))


@register("portfolio_aligned_returns", _feat_plus(_WEIGHTS, f"SELECT portfolio_id, symbol, date, weight, {R('ret', 6)} AS ret FROM rets"))
def q_portfolio_aligned_returns(spark, sf):
    return _rets(spark, sf).withColumn("ret", round_half("ret", 6))


@register("portfolio_cov", _feat_plus(_WEIGHTS, f"""
SELECT a.portfolio_id, a.symbol AS symbol_a, b.symbol AS symbol_b, {R('covar_samp(a.ret, b.ret) * 252', 6)} AS annual_cov
FROM rets a JOIN rets b ON a.portfolio_id = b.portfolio_id AND a.date = b.date
GROUP BY a.portfolio_id, a.symbol, b.symbol"""))
def q_portfolio_cov(spark, sf):
    return portfolio.portfolio_cov(_rets(spark, sf))


@register("portfolio_risk", _feat_plus(_WEIGHTS + """,
er AS (SELECT portfolio_id, sum(weight * m) * 252 AS er FROM
       (SELECT portfolio_id, symbol, weight, avg(ret) AS m FROM rets GROUP BY ALL) GROUP BY portfolio_id),
pv AS (SELECT portfolio_id, stddev_samp(pr) * sqrt(252) AS v FROM
       (SELECT portfolio_id, date, sum(weight * ret) AS pr FROM rets GROUP BY ALL) GROUP BY portfolio_id)""", f"""
SELECT portfolio_id, {R('er', 6)} AS expected_annual_return, {R('v', 6)} AS annual_volatility,
       {R('(er - 0.04::DOUBLE) / nullif(v, 0)', 6)} AS sharpe_ratio,
       CASE WHEN (er - 0.04::DOUBLE) / nullif(v, 0) > 1 THEN 'Premium Returns' ELSE 'Moderate Returns' END AS sharpe_label
FROM er JOIN pv USING (portfolio_id)"""))
def q_portfolio_risk(spark, sf):
    """Of the offered portfolios only those that total 100% are scored."""
    good = portfolio.valid_portfolios(_offered(spark, sf))
    return portfolio.portfolio_risk(portfolio.aligned_returns(_fact(spark, sf), good))


def _offered(spark, sf):
    """The region portfolios and, of each, a second one whose first member weighs 5% more (so it totals 105)."""
    w = _weights(spark, sf)
    off = w.withColumn("weight_pct", F.when(F.col("symbol") == F.min("symbol").over(Window.partitionBy("portfolio_id")),
                                            F.col("weight_pct") + 5).otherwise(F.col("weight_pct")))
    return w.unionByName(off.withColumn("portfolio_id", F.concat("portfolio_id", F.lit(" +5"))))


@register("portfolio_validation", _feat_plus(_WEIGHTS, """
SELECT portfolio_id, CAST(sum(weight_pct) AS BIGINT) AS total_weight_pct, count(*) AS n_assets, sum(weight_pct) = 100 AS is_valid
FROM w GROUP BY portfolio_id
UNION ALL
SELECT portfolio_id || ' +5', CAST(sum(weight_pct) + 5 AS BIGINT), count(*), sum(weight_pct) + 5 = 100 FROM w GROUP BY portfolio_id"""))
def q_portfolio_validation(spark, sf):
    return portfolio.validate_weights(_offered(spark, sf))


@register("portfolio_growth", _feat_plus(_WEIGHTS + """,
daily AS (SELECT portfolio_id, date, sum(weight * ret) AS pr FROM rets GROUP BY ALL)""", f"""
SELECT portfolio_id, date, {R('pr', 6)} AS portfolio_return, {R('lg', 6)} AS log_growth,
       printf('%.6e', exp({R('lg', 9)})) AS growth
FROM (SELECT *, sum(ln(1 + pr)) OVER (PARTITION BY portfolio_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lg
      FROM daily)"""))
def q_portfolio_growth(spark, sf):
    return portfolio.portfolio_growth(_rets(spark, sf))


# ------------------------------------------------------------------ forecasting (features, split)

_FEATS = forecast.feature_names("1d")
_LAGGED = """lagged AS (SELECT *, """ + ", ".join(
    f"lag(close, {n}) OVER ws AS close_lag_{n}, CAST(lag(volume, {n}) OVER ws AS DOUBLE) AS volume_lag_{n}, "
    f"lag(daily_return, {n}) OVER ws AS return_lag_{n}" for n in forecast.LAGS
) + """, lead(close, 1) OVER ws AS target_close FROM feat_1d WINDOW ws AS (PARTITION BY symbol ORDER BY seq)),
train AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY seq) - 1 AS split_rank,
                 count(*) OVER (PARTITION BY symbol) AS n_train_rows
          FROM lagged WHERE """ + " AND ".join(f"{c} IS NOT NULL" for c in _FEATS + ["target_close"]) + ")"
_LAG_COLS = [f"{p}_lag_{n}" for n in forecast.LAGS for p in ("close", "volume", "return")] + ["target_close"]


@register("lag_features", _feat_plus(_LAGGED, f"SELECT symbol, date, {_sr(_LAG_COLS)} FROM lagged"))
def q_lag_features(spark, sf):
    lf = forecast.lag_features(_fact(spark, sf))
    return _r(lf, _LAG_COLS).select("symbol", "date", *_LAG_COLS)


@register("training_rows", _feat_plus(_LAGGED, """
SELECT symbol, n_train_rows, n_train_rows >= 100 AS eligible,
       CAST(floor(n_train_rows * 0.8::DOUBLE) AS BIGINT) AS n_train, n_train_rows - CAST(floor(n_train_rows * 0.8::DOUBLE) AS BIGINT) AS n_test
FROM train GROUP BY symbol, n_train_rows"""))
def q_training_rows(spark, sf):
    t = forecast.training_rows(_fact(spark, sf))
    return (t.groupBy("symbol", "n_train_rows", "eligible")
            .agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test")))


@register("latest_vector", _feat_plus(_LAGGED, f"SELECT symbol, date, {_sr(_FEATS)} FROM lagged WHERE seq = n_bars - 1"))
def q_latest_vector(spark, sf):
    lv = forecast.latest_vector(_fact(spark, sf))
    return _r(lv, _FEATS).select("symbol", "date", *_FEATS)


@register("chrono_split", _feat_plus(_LAGGED, """
SELECT symbol, date, split_rank, split_rank >= floor(n_train_rows * 0.8::DOUBLE) AS is_test FROM train"""))
def q_chrono_split(spark, sf):
    return forecast.training_rows(_fact(spark, sf)).select("symbol", "date", "split_rank", "is_test")


# Three predictors that SQL can state, judged by the same metrics and the same choice of the best model.
_NAIVE = {"Linear_Regression": "close", "Random_Forest": "(close + close_lag_1) / 2", "Gradient_Boosting": "sma_20"}
_NAIVE_CTES = _LAGGED + """,
pred AS (""" + " UNION ALL ".join(
    f"SELECT symbol, '{m}' AS model, {k} AS place, split_rank >= floor(n_train_rows * 0.8::DOUBLE) AS is_test, target_close AS y, {x} AS p "
    "FROM train WHERE n_train_rows >= 100" for k, (m, x) in enumerate(_NAIVE.items())) + f"""),
met AS (SELECT symbol, model, place, {R("avg(abs(y - p)) FILTER (is_test)", 6)} AS test_mae,
  {R("sqrt(avg((y - p) * (y - p)) FILTER (is_test))", 6)} AS test_rmse,
  {R("1 - sum((y - p) * (y - p)) FILTER (is_test) / nullif(var_pop(y) FILTER (is_test) * count(*) FILTER (is_test), 0)", 6)} AS test_r2,
  {R("avg(abs(y - p)) FILTER (NOT is_test)", 6)} AS train_mae,
  {R("1 - sum((y - p) * (y - p)) FILTER (NOT is_test) / nullif(var_pop(y) FILTER (NOT is_test) * count(*) FILTER (NOT is_test), 0)", 6)} AS train_r2
  FROM pred GROUP BY symbol, model, place)"""


def _naive_metrics(spark, sf):
    t = forecast.training_rows(_fact(spark, sf)).filter("eligible")
    preds = [t.select("symbol", F.lit(m).alias("model"), "is_test", "target_close", F.expr(x).alias("prediction")) for m, x in _NAIVE.items()]
    return forecast.metrics_by_split(preds[0].unionByName(preds[1]).unionByName(preds[2]))


@register("metrics_naive", _feat_plus(_NAIVE_CTES, "SELECT symbol, model, test_mae, test_rmse, test_r2, train_mae, train_r2 FROM met"))
def q_metrics_naive(spark, sf):
    return _naive_metrics(spark, sf)


@register("best_model_naive", _feat_plus(_NAIVE_CTES, """
SELECT symbol, CASE WHEN top < 0 THEN 'Linear_Regression' ELSE model END AS best_model,
       CASE WHEN top < 0 THEN linear ELSE top END AS best_test_r2
FROM (SELECT symbol, model, test_r2 AS top, max(CASE WHEN place = 0 THEN test_r2 END) OVER (PARTITION BY symbol) AS linear,
             row_number() OVER (PARTITION BY symbol ORDER BY test_r2 DESC, place) AS n FROM met) WHERE n = 1"""))
def q_best_model_naive(spark, sf):
    return forecast.best_model(_naive_metrics(spark, sf))


@register("training_summary", _feat_plus(_LAGGED, """
SELECT f.symbol, count(t.symbol) AS n_train_rows, CASE WHEN count(t.symbol) < 100 THEN 'skipped' ELSE 'trained' END AS status,
       CAST(NULL AS VARCHAR) AS error
FROM (SELECT DISTINCT symbol FROM feat_1d) f LEFT JOIN train t ON t.symbol = f.symbol GROUP BY f.symbol"""))
def q_training_summary(spark, sf):
    return forecast.training_summary(_fact(spark, sf))


# ------------------------------------------------------------------ forecasting (models; rows-only)

def _forecasters(spark, sf):
    return P._memo(spark, sf, "forecasters_1d", lambda: forecast.fit_forecasters(_fact(spark, sf)))


def _metrics(spark, sf):
    from barspark.session import materialize
    return P._memo(spark, sf, "forecast_metrics_1d",
                   lambda: materialize(forecast.forecast_metrics(_forecasters(spark, sf)), "forecast_metrics"))


def _best(spark, sf):
    return forecast.best_model(_metrics(spark, sf))


@register("forecast_metrics")
def q_forecast_metrics(spark, sf):
    return _metrics(spark, sf)


@register("best_model")
def q_best_model(spark, sf):
    return _best(spark, sf)


@register("forecast_next")
def q_forecast_next(spark, sf):
    n = forecast.forecast_next(_forecasters(spark, sf), _fact(spark, sf), _best(spark, sf))
    # the dashboard's date texts: of the forecast's day and of the chart's ticks
    return n.withColumns({"date_text": F.date_format("date", "EEEE, MMM dd, yyyy"), "tick_text": F.date_format("date", "MM/dd")})


@register("backtest")
def q_backtest(spark, sf):
    return forecast.backtest(_forecasters(spark, sf), _best(spark, sf))


@register("feature_importance")
def q_feature_importance(spark, sf):
    return forecast.feature_importance(_forecasters(spark, sf), _best(spark, sf))


# ------------------------------------------------------------------ indicators with other windows, on another column

def _windows_sql(x: str, sma: int, ema: int, rsi: int, macd: tuple, bb: tuple) -> str:
    a = lambda n: f"(2.0::DOUBLE / {n + 1})"
    step = lambda prev, v, n: f"((1 - {a(n)}) * {prev} + {a(n)} * {v})"
    half = lambda prev, v: f"CASE WHEN b.seq = 1 THEN {v} ELSE (1 - 1.0::DOUBLE / {rsi}) * {prev} + (1.0::DOUBLE / {rsi}) * {v} END"
    over = lambda n: f"OVER (PARTITION BY b.symbol ORDER BY b.seq ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    full = lambda f, n: f"CASE WHEN count(b.x) {over(n)} = {n} THEN {f}(b.x) {over(n)} END"
    fast, slow = step("r.fast", "b.x", macd[0]), step("r.slow", "b.x", macd[1])
    mid, sd = full("avg", bb[0]), full("stddev_samp", bb[0])
    up, low = f"{mid} + {bb[1]}::DOUBLE * {sd}", f"{mid} - {bb[1]}::DOUBLE * {sd}"
    return with_bars(f""", xs AS MATERIALIZED (
  SELECT symbol, ts, date, {x} AS x, row_number() OVER s - 1 AS seq, lag({x}) OVER s AS before, count(*) OVER (PARTITION BY symbol) AS n
  FROM bars_1d WINDOW s AS (PARTITION BY symbol ORDER BY ts)),
rec AS (
  SELECT symbol, seq, x AS ema, x AS fast, x AS slow, 0.0::DOUBLE AS signal, 0.0::DOUBLE AS gain, 0.0::DOUBLE AS loss FROM xs WHERE seq = 0
  UNION ALL
  SELECT b.symbol, b.seq, {step('r.ema', 'b.x', ema)}, {fast}, {slow}, {step('r.signal', f'({fast} - {slow})', macd[2])},
         {half('r.gain', 'greatest(b.x - b.before, 0)')}, {half('r.loss', 'greatest(b.before - b.x, 0)')}
  FROM rec r JOIN xs b ON b.symbol = r.symbol AND b.seq = r.seq + 1)
SELECT b.symbol, b.date, {R(full('avg', sma))} AS sma_{sma}, {R('r.ema')} AS ema_{ema},
  {R(f"CASE WHEN n < {rsi} THEN NULL WHEN b.seq >= {rsi} AND loss <> 0 THEN 100 - 100 / (1 + gain / loss) ELSE 50.0 END")} AS rsi_{rsi},
  {R('fast - slow')} AS macd_line, {R('signal')} AS macd_signal, {R('fast - slow - signal')} AS macd_hist,
  {R(mid)} AS bb_middle, {R(up)} AS bb_upper, {R(low)} AS bb_lower, {R(f'(({up}) - ({low})) / nullif({mid}, 0)')} AS bb_bandwidth
FROM xs b JOIN rec r USING (symbol, seq)""").replace("WITH ", "WITH RECURSIVE ", 1)


@register("indicators_other_windows", _windows_sql("high", 10, 9, 7, (5, 13, 4), (15, 1.5)))
def q_indicators_other_windows(spark, sf):
    e = indicators.enrich(P.bars(spark, sf, "1d"), "1d", "high", indicators.Windows((10,), (9,), 7, (5, 13, 4), (15, 1.5)))
    cols = ["sma_10", "ema_9", "rsi_7", "macd_line", "macd_signal", "macd_hist", "bb_middle", "bb_upper", "bb_lower", "bb_bandwidth"]
    return _r(e, cols).select("symbol", "date", *cols)


# ------------------------------------------------------------------ loads, exports, file names

@register("load_symbol", with_features(f"SELECT ts, {R('close')} AS close, volume FROM feat_1d WHERE symbol = 'NATION_12'"))
def q_load_symbol(spark, sf):
    """One symbol out of the partitioned fact table."""
    import uuid
    from barspark.session import checkpoint_dir
    from barspark.sources.warehouse import load_symbol, write_facts
    path = f"{checkpoint_dir(spark).rstrip('/')}/warehouse/fact-{uuid.uuid4().hex[:10]}"
    write_facts(_fact(spark, sf), path)
    return load_symbol(spark, path, "NATION_12", columns=["ts", "close", "volume"]).withColumn("close", round_half("close"))


@register("missing_symbols", with_bars("SELECT symbol FROM dim WHERE symbol NOT IN (SELECT symbol FROM bars_1d WHERE volume % 2 = 0 "
                                       "GROUP BY symbol HAVING count(*) > 600)", dim=True))
def q_missing_symbols(spark, sf):
    from barspark.sources.bars import missing_symbols
    busy = P.bars(spark, sf, "1d").filter("volume % 2 = 0").groupBy("symbol").count().filter("count > 600")
    return missing_symbols(busy, P.dim(spark, sf))


@register("file_stems", with_bars("SELECT symbol, replace(symbol, '.', '_') || '_historical' AS stem, count(*) AS n_rows, "
                                  f"{R('sum(close)', 2)} AS sum_close FROM (SELECT replace(symbol, '_', '.') AS symbol, close FROM bars_1d) "
                                  "GROUP BY symbol"))
def q_file_stems(spark, sf):
    """One CSV per symbol, named by its stem: each file's stem as found on disk and its rows as read back."""
    import uuid
    from barspark.session import checkpoint_dir
    from barspark.sources.warehouse import write_vendor_files
    path = f"{checkpoint_dir(spark).rstrip('/')}/vendor/stems-{uuid.uuid4().hex[:10]}"
    b = P.bars(spark, sf, "1d").select(F.translate("symbol", "_", ".").alias("symbol"), "date", "close")
    write_vendor_files(b, path, "historical")
    back = spark.read.option("header", True).schema("symbol string, date date, close double").csv(f"{path}/*.csv")
    stem = F.regexp_extract("_metadata.file_path", r"([^/]+)\.csv/[^/]*$", 1)
    return back.groupBy("symbol", stem.alias("stem")).agg(F.count(F.lit(1)).alias("n_rows"), round_half(F.sum("close"), 2).alias("sum_close"))


@register("export_report", with_features(f"""
SELECT 'Performance_output.csv' AS file, symbol, CAST(count(*) AS VARCHAR) AS total_trading_days FROM feat_1d GROUP BY symbol"""))
def q_export_report(spark, sf):
    """A report exported as CSV with its header and read back as texts."""
    import uuid
    from barspark.session import checkpoint_dir
    from barspark.sources.warehouse import export_csv, export_name
    file = export_name("Performance summary")
    path = f"{checkpoint_dir(spark).rstrip('/')}/exports/{uuid.uuid4().hex[:10]}/{file}"
    export_csv(reports.perf_summary(_fact(spark, sf), P.dim(spark, sf)), path)
    back = spark.read.option("header", True).csv(path)
    return back.select(F.lit(file).alias("file"), "symbol", "total_trading_days")


# ------------------------------------------------------------------ warehouse sinks

_REPLACE_SQL = (with_features("", "1d").rstrip() + ",\n" + feature_ctes("1h") +
                f"\nSELECT grain, symbol, count(*) AS n_rows, {R('sum(close)', 2)} AS sum_close, CAST(sum(volume) AS BIGINT) AS sum_volume, "
                "min(ts) AS first_ts, max(ts) AS last_ts FROM (SELECT grain, symbol, ts, close, volume FROM feat_1d "
                "UNION ALL SELECT grain, symbol, ts, close, volume FROM feat_1h) GROUP BY grain, symbol")


@register("replace_by_symbol", _REPLACE_SQL)
def q_replace_by_symbol(spark, sf):
    """Load daily then intraday facts into one table, then re-run the daily load:
    both grains survive and the re-run leaves counts and sums unchanged."""
    import uuid
    from barspark.session import checkpoint_dir
    from barspark.sources.warehouse import fact_table, write_facts
    path = f"{checkpoint_dir(spark).rstrip('/')}/warehouse/fact-{uuid.uuid4().hex[:10]}"
    d, h = _fact(spark, sf, "1d"), _fact(spark, sf, "1h")
    write_facts(d, path)
    write_facts(h, path)
    write_facts(d, path)
    return fact_table(spark, path).read().groupBy("grain", "symbol").agg(
        F.count(F.lit(1)).alias("n_rows"), round_half(F.sum("close"), 2).alias("sum_close"), F.sum("volume").alias("sum_volume"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


# Feature columns by the vendor name that the column map knows them under (the first of two names of one column).
_VENDOR_NAMES = {}
for _name, _col in VENDOR_COLUMN_MAP.items():
    _feature = {"volatility_20d": "volatility", "Daily_Return_Outlier": "daily_return_outlier",
                "Volume_Outlier": "volume_outlier"}.get(_col, _col)
    if _feature != "adj_close":
        _VENDOR_NAMES.setdefault(_feature, _name)
_VENDOR_NAMES["close_rolling_mean_20"] = "Close_Rolling_Mean_20"  # not in the map: must be dropped by it
_FACT_DBL = ["open", "high", "low", "close", "adj_close", "daily_return", "pct_change", "volatility_20d",
             "sma_20", "sma_50", "ema_20", "rsi_14", "macd_line", "macd_signal", "macd_hist",
             "bb_upper", "bb_middle", "bb_lower", "bb_bandwidth"]


@register("column_map", with_features(
    "SELECT CAST(date AS VARCHAR) AS date, symbol, volume, daily_return_outlier AS Daily_Return_Outlier, "
    "volume_outlier AS Volume_Outlier, " + ", ".join(
        f"{R('volatility' if c == 'volatility_20d' else c)} AS {c}" for c in _FACT_DBL) + " FROM feat_1d"))
def q_column_map(spark, sf):
    """Processed bars in the vendor layout mapped onto the fact columns."""
    from barspark.sources.warehouse import map_columns
    f = _fact(spark, sf)
    vendor = f.select(*[F.col(k).alias(v) for k, v in _VENDOR_NAMES.items()])
    return _r(map_columns(vendor), _FACT_DBL)


@register("vendor_roundtrip", with_bars(
    f"SELECT symbol, grain, ts, date, {_sr(['open', 'high', 'low', 'close'])}, adj_close, volume FROM bars_1d"))
def q_vendor_roundtrip(spark, sf):
    """Bars written as per-symbol vendor CSV files (Date, Open, ..., Ticker) and read
    back for all symbols at once with the explicit vendor schema."""
    import uuid
    from barspark.session import checkpoint_dir
    from barspark.sources.bars import read_vendor_bars
    from barspark.sources.warehouse import write_per_symbol_csv
    path = f"{checkpoint_dir(spark).rstrip('/')}/vendor/daily-{uuid.uuid4().hex[:10]}"
    b = P.bars(spark, sf, "1d")
    vendor = b.select(F.date_format("date", "yyyy-MM-dd").alias("Date"), F.col("open").alias("Open"),
                      F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"),
                      F.col("volume").alias("Volume"), F.lit(0.0).alias("Dividends"),
                      F.lit(0.0).alias("Stock Splits"), F.col("symbol").alias("Ticker"), F.col("symbol"))
    write_per_symbol_csv(vendor, path)
    back = read_vendor_bars(spark, f"{path}/symbol=*/*.csv", "1d")
    return _r(back, ["open", "high", "low", "close"]).select(*BAR_COLS)


@register("vendor_mixed_headers", with_bars(f"""
SELECT symbol, date, {_sr(['open', 'high', 'low'])}, CASE WHEN volume % 10 <> 3 THEN {R('close')} END AS close,
       CASE WHEN symbol < 'NATION_2' THEN {R('close')} END AS adj_close, volume FROM bars_1d"""))
def q_vendor_mixed_headers(spark, sf):
    """Files of two header layouts (one with Adj Close, columns in another order), NaN closes and a missing path."""
    import uuid
    from barspark.session import checkpoint_dir
    from barspark.sources.bars import read_vendor_bars
    path = f"{checkpoint_dir(spark).rstrip('/')}/vendor/mixed-{uuid.uuid4().hex[:10]}"
    v = P.bars(spark, sf, "1d").select(
        F.date_format("date", "yyyy-MM-dd").alias("Date"), F.col("open").alias("Open"), F.col("high").alias("High"),
        F.col("low").alias("Low"), F.when(F.col("volume") % 10 == 3, F.lit("NaN")).otherwise(F.col("close").cast("string")).alias("Close"),
        F.col("close").alias("Adj Close"), F.col("volume").alias("Volume"), F.col("symbol").alias("Ticker"))
    early = v.filter("Ticker < 'NATION_2'").select("Ticker", "Adj Close", "Date", "Open", "High", "Low", "Close", "Volume")
    early.write.option("header", True).csv(f"{path}/a")
    v.filter("Ticker >= 'NATION_2'").drop("Adj Close").write.option("header", True).csv(f"{path}/b")
    back = read_vendor_bars(spark, [f"{path}/a/*.csv", f"{path}/none/*.csv", f"{path}/b/*.csv"], "1d")
    return _r(back, ["open", "high", "low", "close", "adj_close"]).select(
        "symbol", "date", "open", "high", "low", "close", "adj_close", "volume")


# Vendor rows with planted faults, by a rule on the day since 1970: unreadable dates, prices that are no numbers, no symbol.
_PLANTED = ("(SELECT *, date_diff('day', DATE '1970-01-01', date) AS d FROM bars_1d)")


@register("rejected_rows", with_bars(f"""
SELECT reason, count(*) AS n_rows, count(DISTINCT d) AS n_days FROM (
  SELECT d, unnest([CASE WHEN d % 7 = 3 THEN 'bad_stamp' END, CASE WHEN d % 11 = 5 THEN 'bad_close' END,
    CASE WHEN d % 11 = 6 THEN 'bad_volume' END, CASE WHEN d % 13 = 2 THEN 'no_symbol' END,
    CASE WHEN NOT (d % 7 = 3 OR d % 11 IN (5, 6) OR d % 13 = 2) THEN 'accepted' END]) AS reason
  FROM {_PLANTED}) WHERE reason IS NOT NULL GROUP BY reason"""))
def q_rejected_rows(spark, sf):
    """Vendor files with unreadable rows: accepted bars and rejected rows by reason, each with its days."""
    import uuid
    from barspark.session import checkpoint_dir
    from barspark.sources.bars import split_vendor_bars
    base = f"{checkpoint_dir(spark).rstrip('/')}/vendor/faulty-{uuid.uuid4().hex[:10]}"
    d = F.datediff("date", F.lit("1970-01-01").cast("date"))
    v = P.bars(spark, sf, "1d").withColumn("d", d).select(
        F.when(F.col("d") % 7 == 3, F.concat(F.lit("day "), F.col("d").cast("string"))).otherwise(F.col("date").cast("string")).alias("Date"),
        F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
        F.when(F.col("d") % 11 == 5, F.lit("1.2.3")).when(F.col("d") % 11 == 7, F.lit("NaN")).otherwise(F.col("close").cast("string")).alias("Close"),
        F.when(F.col("d") % 11 == 6, F.lit("many")).otherwise(F.col("volume").cast("string")).alias("Volume"),
        F.when(F.col("d") % 13 != 2, F.col("symbol")).alias("Ticker"), F.col("d").alias("Dividends"))
    v.write.option("header", True).csv(f"{base}/in")
    bars, rejected = split_vendor_bars(spark, f"{base}/in/*.csv", f"{base}/split")
    day = F.datediff("date", F.lit("1970-01-01").cast("date"))
    bad = rejected.select(F.explode("reasons").alias("reason"), F.element_at(F.split("line", ","), -1).cast("int").alias("day"))
    return (bars.select(F.lit("accepted").alias("reason"), day.alias("day")).unionByName(bad)
            .groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("day").alias("n_days")))


# The suite's reports, and one name that no report has, whose failure must not stop the others.
_SUITE = ["perf_summary", "mom_trend", "sma_sql", "rsi_alerts", "top_volume_days", "close_pivot", "rebased_growth", "price_corr",
          "clipped_returns", "return_box", "avg_volume_millions", "return_kde", "no_such_report"]


@register("suite_report", " UNION ALL ".join(
    f"SELECT '{n}' AS query_name, 'ok' AS status, count(*) AS n_rows, CAST(NULL AS VARCHAR) AS error FROM ({REGISTRY[n][1]}) AS t"
    if n in REGISTRY else f"SELECT '{n}', 'failed', NULL, '''{n}'''" for n in _SUITE))
def q_suite_report(spark, sf):
    from barspark.plans.suite import run_suite
    return run_suite(spark, sf, _SUITE).select("query_name", "status", "n_rows", "error")


# ------------------------------------------------------------------ streaming

_DELAY_SQL = "INTERVAL 10 MINUTE"


@register("stream_bars", with_bars(f"""
SELECT symbol, ts, {R('open')} AS open, {R('high')} AS high, {R('low')} AS low, {R('close')} AS close, volume
FROM bars_1h WHERE ts + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - {_DELAY_SQL}""", "1h"))
def q_stream_bars(spark, sf):
    from barspark.streaming import live
    out = live.run_to_parquet(live.stream_bars(live.tick_stream(spark, sf)), "bars")
    return _r(out, ["open", "high", "low", "close"])


@register("stream_bars_minute", with_bars(f"""
SELECT symbol, ts, {R('open')} AS open, {R('high')} AS high, {R('low')} AS low, {R('close')} AS close, volume
FROM bars_1m WHERE ts + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - {_DELAY_SQL}""", "1m"))
def q_stream_bars_minute(spark, sf):
    from barspark.streaming import live
    out = live.run_to_parquet(live.stream_bars(live.tick_stream(spark, sf), "1 minute"), "bars_1m")
    return _r(out, ["open", "high", "low", "close"])


@register("stream_dedup", f"SELECT event_type AS symbol, ts, {R('value')} AS price FROM events")
def q_stream_dedup(spark, sf):
    """Every third tick arrives a second time (by a rule on event_id); the stream drops the repeats."""
    from barspark.streaming import live
    ticks = live.tick_stream(spark, sf)
    twice = ticks.withColumn("copy", F.explode(F.when(F.col("event_id") % 3 == 0, F.array(F.lit(0), F.lit(1)))
                                               .otherwise(F.array(F.lit(0)))))
    out = live.run_to_parquet(live.stream_dedup(twice), "dedup")
    return out.select("symbol", F.col("ts").cast("timestamp_ntz").alias("ts"), round_half("price").alias("price"))


_STREAM_IND = ["daily_return", "volatility", "ema_20", "rsi_14", "macd_line", "macd_signal", "macd_hist"]


def _landed(spark, bars, name: str, files: int = 16):
    """Bars as they land: file after file in the order of time, each bar up to 23 hours late by a rule on its key."""
    from barspark.session import stored
    from barspark.streaming import live
    late = F.expr("make_dt_interval(0, pmod(xxhash64(symbol, ts), 24))")
    path = stored(bars.withColumn("_at", F.col("ts") + late).repartitionByRange(files, "_at").drop("_at"), name)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    for i, p in enumerate(parts):  # the file source takes files by their time of change
        fs.setTimes(p, 1_700_000_000_000 + 60_000 * i, -1)
    return live.file_stream(spark, bars, path, files_per_trigger=5)


def _scattered(spark, bars, name: str, files: int = 16):
    """Bars stored as shuffled part files, as they would land from many feeds; read back as several micro-batches."""
    from barspark.session import stored
    from barspark.streaming import live
    path = stored(bars.repartition(files, F.xxhash64("symbol", "ts")), name)
    return live.file_stream(spark, bars, path, files_per_trigger=5)


@register("stream_indicators", with_features(
    f"SELECT symbol, ts, {R('close')} AS close, " + ", ".join(f"{R(c, 6)} AS {c}" for c in _STREAM_IND)
    + " FROM feat_1h", "1h"))
def q_stream_indicators(spark, sf):
    """Hourly bars landing in 16 files, each bar up to a day out of order, over several micro-batches: most bars settle on the way."""
    import uuid
    from barspark.session import checkpoint_dir
    from barspark.sources.versions import month_of
    from barspark.streaming import live
    src = _landed(spark, P.bars(spark, sf, "1h"), "bars_landed")
    path = f"{checkpoint_dir(spark).rstrip('/')}/warehouse/indicators-{uuid.uuid4().hex[:10]}"
    rows = live.stream_indicators(src, "2 days").withColumn("month", month_of(F.col("ts")))
    out = live.upsert_stream(rows, path, ["symbol", "ts"], ["month"], mode="update")
    return (out.drop("month").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
            .withColumns({"close": round_half("close"), **{c: round_half(c, 6) for c in _STREAM_IND}}))


@register("stream_alerts", with_features(f"""
SELECT f.date, s.company_name, f.symbol, {R('f.close', 2)} AS closing_price, {R('f.rsi_14', 2)} AS rsi_14,
       {R('f.pct_change', 2)} AS daily_pct_change
FROM feat_1d f JOIN dim s ON f.symbol = s.symbol WHERE f.rsi_14 >= 70 OR f.rsi_14 <= 30""", dim=True))
def q_stream_alerts(spark, sf):
    from barspark.streaming import live
    src = _scattered(spark, _fact(spark, sf), "fact_scattered")
    out = live.run_to_parquet(live.stream_alerts(src, P.dim(spark, sf)), "alerts")
    return out.select("date", "company_name", "symbol", round_half("close", 2).alias("closing_price"),
                      round_half("rsi_14", 2).alias("rsi_14"), round_half("pct_change", 2).alias("daily_pct_change"))


@register("stream_upsert", with_bars(
    f"SELECT '1h' AS grain, symbol, ts, date, {_sr(['open', 'high', 'low', 'close'])}, volume FROM bars_1h", "1h"))
def q_stream_upsert(spark, sf):
    """Hourly bars in 16 shuffled files merged batch by batch, then all of them once more: every row is there once."""
    import uuid
    from barspark.session import checkpoint_dir
    from barspark.streaming import live
    path = f"{checkpoint_dir(spark).rstrip('/')}/warehouse/stream-{uuid.uuid4().hex[:10]}"
    bars = P.bars(spark, sf, "1h")
    cols = ["symbol", "ts", "date", "open", "high", "low", "close", "volume"]
    for _ in range(2):
        out = live.stream_upsert(_scattered(spark, bars, "bars_scattered").select(*cols), path)
    return _r(out, ["open", "high", "low", "close"]).select("grain", *cols)


@register("stream_vendor_files", with_bars(
    f"SELECT '1h' AS grain, symbol, ts, date, {_sr(['open', 'high', 'low'])}, CASE WHEN volume % 10 <> 3 THEN {R('close')} END AS close, "
    f"CASE WHEN hour(ts) % 2 = 0 THEN {R('close')} END AS adj_close, volume FROM bars_1h", "1h"))
def q_stream_vendor_files(spark, sf):
    """Hourly vendor CSV files of two header layouts landing over several batches, and a file of unreadable rows."""
    import uuid
    from barspark.session import checkpoint_dir
    from barspark.streaming import live
    base = f"{checkpoint_dir(spark).rstrip('/')}/vendor/landing-{uuid.uuid4().hex[:10]}"
    v = P.bars(spark, sf, "1h").select(
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00")).alias("Datetime"), F.col("open").alias("Open"),
        F.col("high").alias("High"), F.col("low").alias("Low"),
        F.when(F.col("volume") % 10 == 3, F.lit("NaN")).otherwise(F.col("close").cast("string")).alias("Close"),
        F.col("close").alias("Adj Close"), F.col("volume").alias("Volume"), F.col("symbol").alias("Ticker"), F.hour("ts").alias("h"))
    even = v.filter("h % 2 = 0").select("Ticker", "Adj Close", "Datetime", "Open", "High", "Low", "Close", "Volume")
    even.repartition(8).write.option("header", True).csv(f"{base}/in/a")
    v.filter("h % 2 = 1").drop("Adj Close", "h").repartition(8).write.option("header", True).csv(f"{base}/in/b")
    v.filter("h = 0").select(F.lit("?").alias("Datetime"), "Open", "High", "Ticker").coalesce(1).write.option("header", True).csv(f"{base}/in/c")
    out, _ = live.stream_vendor_files(spark, f"{base}/in/*", f"{base}/out", "1h")
    return _r(out, ["open", "high", "low", "close", "adj_close"]).select(
        "grain", "symbol", "ts", "date", "open", "high", "low", "close", "adj_close", "volume")
