"""Canonical schemas of the bar, feature and dimension tables."""

from __future__ import annotations

from pyspark.sql import types as T

_D = T.DoubleType()

BAR = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("grain", T.StringType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("open", _D), T.StructField("high", _D),
    T.StructField("low", _D), T.StructField("close", _D),
    T.StructField("adj_close", _D),
    T.StructField("volume", T.LongType()),
])

INDICATOR_COLUMNS = [
    "sma_20", "sma_50", "ema_20", "rsi_14", "macd_line", "macd_signal",
    "macd_hist", "bb_upper", "bb_middle", "bb_lower", "bb_bandwidth",
]

FEATURE_COLUMNS = (
    [f.name for f in BAR.fields]
    + ["daily_return", "pct_change", "volatility", "close_rolling_mean_20",
       "close_rolling_std_20", "volume_rolling_mean_20"]
    + INDICATOR_COLUMNS
    + ["daily_return_outlier", "volume_outlier"]
)

FEATURE = T.StructType(
    list(BAR.fields)
    + [T.StructField(c, _D) for c in FEATURE_COLUMNS[len(BAR.fields):-2]]
    + [T.StructField("daily_return_outlier", T.BooleanType(), False),
       T.StructField("volume_outlier", T.BooleanType(), False)]
)

DIM = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("company_name", T.StringType(), False),
    T.StructField("sector", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("exchange", T.StringType()),
])

# vendor/processed column name -> fact column name, as the
# reference's loader maps them (intraday datetime and 5-bar volatility land
# in the same columns as their daily counterparts).
VENDOR_COLUMN_MAP = {
    "Date": "date",
    "Datetime": "date",
    "Ticker": "symbol",
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Adj Close": "adj_close",
    "Volume": "volume",
    "Daily_Return": "daily_return",
    "Pct_Change": "pct_change",
    "Volatility_20d": "volatility_20d",
    "Volatility_5m": "volatility_20d",
    "SMA_20": "sma_20",
    "SMA_50": "sma_50",
    "EMA_20": "ema_20",
    "RSI_14": "rsi_14",
    "MACD_Line": "macd_line",
    "MACD_Signal": "macd_signal",
    "MACD_Hist": "macd_hist",
    "BB_Upper": "bb_upper",
    "BB_Middle": "bb_middle",
    "BB_Lower": "bb_lower",
    "BB_Bandwidth": "bb_bandwidth",
    "Daily_Return_Outlier": "Daily_Return_Outlier",
    "Volume_Outlier": "Volume_Outlier",
}

# Fact-table columns in DDL order with their Spark types; the two flags
# default to FALSE when absent from the input.
FACT_COLUMNS = [
    ("date", T.StringType()), ("symbol", T.StringType()),
    ("open", _D), ("high", _D), ("low", _D), ("close", _D), ("adj_close", _D),
    ("volume", T.LongType()), ("daily_return", _D), ("pct_change", _D),
    ("volatility_20d", _D), ("sma_20", _D), ("sma_50", _D), ("ema_20", _D),
    ("rsi_14", _D), ("macd_line", _D), ("macd_signal", _D), ("macd_hist", _D),
    ("bb_upper", _D), ("bb_middle", _D), ("bb_lower", _D), ("bb_bandwidth", _D),
    ("Daily_Return_Outlier", T.BooleanType()), ("Volume_Outlier", T.BooleanType()),
]
FACT_DEFAULTS = {"Daily_Return_Outlier": False, "Volume_Outlier": False}
