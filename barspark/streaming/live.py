"""Streaming counterparts of the batch operators.

Sources are file streams (parquet landing folders; a Kafka source plugs in
the same way).  Sinks are parquet folders under the shared checkpoint
folder, each with its own checkpoint location, so a restarted query resumes
exactly where it stopped; nothing is collected into driver memory.

* ``stream_bars``       ticks -> OHLCV per (symbol, interval); watermark +
  tumbling window, append mode: a bar is emitted once the watermark passes
  its end (late ticks beyond the delay are dropped).
* ``stream_dedup``      duplicate ticks on (symbol, ts) dropped within the watermark.
* ``stream_indicators`` per-symbol state (running values up to the watermark and
  the bars since) with ``applyInPandasWithState`` in update mode; bars may come in
  any order within the delay, only bars behind the watermark are dropped.
* ``stream_alerts``     stream-static join of features with the dimension,
  RSI threshold filter.
* ``stream_upsert``     ``foreachBatch`` merge by (grain, symbol, ts).
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from barspark.session import checkpoint_dir
from barspark.sources.versions import month_of

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def _paths(spark: SparkSession, name: str) -> tuple[str, str]:
    base = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:10]}"
    return f"{base}/out", f"{base}/_checkpoint"


def run_to_parquet(df: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a streaming DataFrame over everything available now into a parquet folder
    and return the folder as a batch DataFrame."""
    spark = df.sparkSession
    out, ck = _paths(spark, name)
    q = (df.writeStream.format("parquet").outputMode(mode).option("path", out)
         .option("checkpointLocation", ck).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def tick_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """The events table as a tick stream (symbol, ts TIMESTAMP, price, event_id).

    The path is a pattern, so the table may be one file or a folder of part files."""
    raw = (spark.readStream.schema(EVENT_SCHEMA)
           .option("maxFilesPerTrigger", files_per_trigger).parquet(f"{sf_dir.rstrip('/')}/event[s].parquet"))
    # watermarks need TIMESTAMP (with zone); the session zone is UTC
    return raw.select(F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"),
                      F.col("value").alias("price"), "event_id")


def stream_bars(ticks: DataFrame, interval: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    w = F.window("ts", interval)
    key = F.struct("ts", *[c for c in ("event_id",) if c in ticks.columns])  # breaks ties of equal times
    return (ticks.withWatermark("ts", delay).groupBy("symbol", w.alias("w"))
            .agg(F.min_by("price", key).alias("open"), F.max("price").alias("high"),
                 F.min("price").alias("low"), F.max_by("price", key).alias("close"),
                 F.count(F.lit(1)).alias("volume"))
            .select("symbol", F.col("w.start").cast("timestamp_ntz").alias("ts"),
                    "open", "high", "low", "close", "volume"))


def stream_dedup(ticks: DataFrame, delay: str = "10 minutes") -> DataFrame:
    return ticks.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["symbol", "ts"])


# ------------------------------------------------------------------ incremental indicators

# What is known of a symbol after its last settled bar, and the bars since (by time, with their closes).
_STATE = T.StructType([
    T.StructField("last_us", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("close", T.DoubleType()), T.StructField("ema_20", T.DoubleType()),
    T.StructField("fast", T.DoubleType()), T.StructField("slow", T.DoubleType()),
    T.StructField("signal", T.DoubleType()), T.StructField("gain", T.DoubleType()),
    T.StructField("loss", T.DoubleType()), T.StructField("rets", T.ArrayType(T.DoubleType())),
    T.StructField("open_us", T.ArrayType(T.LongType())), T.StructField("open_close", T.ArrayType(T.DoubleType())),
])

INDICATOR_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()), T.StructField("ts", T.TimestampType()),
    T.StructField("close", T.DoubleType()), T.StructField("daily_return", T.DoubleType()),
    T.StructField("volatility", T.DoubleType()), T.StructField("ema_20", T.DoubleType()),
    T.StructField("rsi_14", T.DoubleType()), T.StructField("macd_line", T.DoubleType()),
    T.StructField("macd_signal", T.DoubleType()), T.StructField("macd_hist", T.DoubleType()),
])

# Fixed indicator parameters (same as the batch features).
_A20, _A12, _A26, _A9 = 2.0 / 21, 2.0 / 13, 2.0 / 27, 2.0 / 10
_ARSI, _RSI_N, _VOL_N = 1.0 / 14, 14, 5
_SEED = (None, 0, None, None, None, None, 0.0, 0.0, 0.0, [], [], [])


def _smooth(before: float, values: np.ndarray, alpha: float) -> np.ndarray:
    """``y = (1 - alpha) * y_before + alpha * value`` along an array."""
    return pd.Series(np.concatenate([[before], values])).ewm(alpha=alpha, adjust=False).mean().to_numpy()[1:]


def _indicators(snapshot: tuple, close: np.ndarray) -> dict[str, np.ndarray]:
    """All indicator columns of the bars that follow a snapshot, as arrays."""
    _, n, last, e20, fast, slow, sig, gain, loss, rets = snapshot[:10]
    k = np.arange(n, n + len(close))
    prev = np.concatenate([[np.nan if last is None else last], close[:-1]])
    with np.errstate(divide="ignore", invalid="ignore"):
        ret = np.where(prev == 0, np.nan, close / prev - 1)
    diff = close - prev
    up, down = np.maximum(diff, 0.0), np.maximum(-diff, 0.0)
    out = {"daily_return": np.where(k == 0, 0.0, ret)}
    if n == 0:
        e20, fast, slow, sig = close[0], close[0], close[0], 0.0
        up[0] = down[0] = 0.0
    out["ema_20"], f, s = _smooth(e20, close, _A20), _smooth(fast, close, _A12), _smooth(slow, close, _A26)
    line = f - s
    out["fast"], out["slow"], out["macd_line"], out["macd_signal"] = f, s, line, _smooth(sig, line, _A9)
    out["macd_hist"] = line - out["macd_signal"]
    for name, before, x in (("gain", gain, up), ("loss", loss, down)):
        y = np.zeros(len(x))
        first = max(0, min(2 - n, len(x)))  # the smoothing starts from the first difference
        if first and n + first > 1:
            y[first - 1] = before = x[first - 1]
        y[first:] = _smooth(before, x[first:], _ARSI)
        out[name] = y
    with np.errstate(divide="ignore", invalid="ignore"):
        out["rsi_14"] = np.where((k >= _RSI_N) & (out["loss"] != 0), 100 - 100 / (1 + out["gain"] / out["loss"]), 50.0)
    out["rets"] = np.concatenate([np.asarray([np.nan if x is None else x for x in rets], float), out["daily_return"]])
    volatility = np.zeros(len(out["rets"]))
    if len(volatility) >= _VOL_N:
        volatility[_VOL_N - 1:] = np.nan_to_num(np.lib.stride_tricks.sliding_window_view(out["rets"], _VOL_N).std(axis=1, ddof=1))
    out["volatility"] = volatility[len(rets):]
    return out


def _indicator_step(key, pdfs, state):
    """Merge a micro-batch into a symbol's open bars and give every bar from the earliest new one on anew.

    Bars up to the watermark are then settled: they leave the open bars and
    only their running values stay.  A timer at the last open bar settles them
    also when no further bar of the symbol comes.  A bar that is not after the
    last settled one is late and dropped."""
    old = tuple(state.get) if state.exists else _SEED
    last_us = old[0]
    us, close = [np.asarray(old[10], np.int64)], [np.asarray(old[11], float)]
    for pdf in pdfs:
        us.append(pdf["ts"].to_numpy().astype("datetime64[us]").astype(np.int64))
        close.append(pdf["close"].to_numpy(float))
    had = len(us[0])
    us, close = np.concatenate(us), np.concatenate(close)
    us, first = np.unique(us, return_index=True)  # of bars of one time the first to arrive stays
    close, new = close[first], first >= had
    if last_us is not None:
        on_time = us > last_us
        us, close, new = us[on_time], close[on_time], new[on_time]
    if not len(us):
        return  # only late bars: the timer stands as it was
    cols = _indicators(old, close)
    if new.any():
        at = int(np.argmax(new))
        out = {"symbol": key[0], "ts": us[at:].astype("datetime64[us]"), "close": close[at:]}
        out.update({c: cols[c][at:] for c in INDICATOR_SCHEMA.names[3:]})
        yield pd.DataFrame(out)
    done = int(np.searchsorted(us, state.getCurrentWatermarkMs() * 1000, "right"))
    if done:
        i = done - 1
        n_rets = len(old[9])
        settled = (int(us[i]), int(old[1] + done), *(float(x) for x in (
            close[i], cols["ema_20"][i], cols["fast"][i], cols["slow"][i], cols["macd_signal"][i], cols["gain"][i], cols["loss"][i])),
            [None if np.isnan(x) else float(x) for x in cols["rets"][: n_rets + done][-(_VOL_N - 1):]])
    else:
        settled = old[:10]
    state.update((*settled, us[done:].tolist(), close[done:].tolist()))
    if done < len(us):
        state.setTimeoutTimestamp(int(us[-1]) // 1000 + 1)


def stream_indicators(bars: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Live return, 5-bar volatility, EMA 20, RSI 14, MACD per symbol from a bar stream (update mode).

    A bar is given at once; if earlier bars arrive within ``delay``, the
    later ones are given again with their new values, so the sink keeps the
    last row per (symbol, ts): see ``upsert_stream``.  State holds a symbol's
    bars that the watermark has not passed and ten running values."""
    return (bars.select("symbol", F.col("ts").cast("timestamp").alias("ts"), "close").withWatermark("ts", delay)
            .groupBy("symbol")
            .applyInPandasWithState(_indicator_step, INDICATOR_SCHEMA, _STATE, "update",
                                    GroupStateTimeout.EventTimeTimeout))


def stream_alerts(features: DataFrame, dim: DataFrame) -> DataFrame:
    """RSI threshold hits joined with the company name (stream-static join)."""
    hits = features.filter((F.col("rsi_14") >= 70) | (F.col("rsi_14") <= 30))
    return hits.join(dim.select("symbol", "company_name"), "symbol")


def upsert_stream(rows: DataFrame, path: str, keys: list[str], partitions: list[str], mode: str = "append",
                  order: list[str] | None = None, prepare=None) -> DataFrame:
    """Merge every micro-batch of a stream into a versioned folder, one transaction each: of each key the newest batch's
    row stays, within a batch the one with the largest ``order`` columns.

    ``partitions`` are columns of ``rows`` that the keys determine; a batch rewrites only the
    partitions that it touches.  The folder knows the stream's last epoch, so a batch that runs again is left out.
    ``prepare(batch, epoch)`` makes a batch's rows where a plan over one batch is needed."""
    from barspark.sources.versions import VersionedTable
    spark = rows.sparkSession
    out, ck = _paths(spark, "upsert")
    target = VersionedTable(spark, path, partitions)

    def load(batch: DataFrame, epoch: int) -> None:
        batch = (prepare(batch, epoch) if prepare else batch).persist()  # read for its partitions, its keys and its rows
        try:
            if not batch.isEmpty():
                VersionedTable(batch.sparkSession, path, partitions).merge(batch, keys, order, (out, epoch))
        finally:
            batch.unpersist()

    q = (rows.writeStream.foreachBatch(load).outputMode(mode).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return target.read()


def stream_upsert(bars: DataFrame, path: str, grain: str = "1h", order: list[str] | None = None) -> DataFrame:
    """Bars of a stream merged into the fact folder by (grain, symbol, ts), partitioned by (grain, month)."""
    rows = bars.withColumns({"grain": F.lit(grain), "month": month_of(F.col("ts"))})
    return upsert_stream(rows, path, ["grain", "symbol", "ts"], ["grain", "month"], order=order).drop("month")


def file_stream(spark: SparkSession, like: DataFrame, path: str, files_per_trigger: int = 4) -> DataFrame:
    """A parquet folder (e.g. a materialized table) read as a stream."""
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_vendor_files(spark: SparkSession, files: str, path: str, grain: str = "1m", files_per_trigger: int = 4) -> tuple[DataFrame, DataFrame]:
    """Vendor CSV files as they land, merged into the fact folder ``path``/bars; also the rejected rows.

    A micro-batch holds whole files, each read by its own header as ``read_vendor_bars`` does; of a bar that
    lands again the newest batch's row stays.  Rejected rows go to ``path``/landed, one folder per epoch, which
    a batch that runs again writes anew."""
    from barspark.sources.bars import _by_header, parse_vendor, split_rows
    lines = (spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(files)
             .select("value", F.col("_metadata.file_path").alias("_file")))
    base = path.rstrip("/")

    def prepare(batch: DataFrame, epoch: int) -> DataFrame:
        bars, _ = split_rows(parse_vendor(_by_header(batch), grain), f"{base}/landed/epoch={epoch}")
        return bars.withColumn("month", month_of(F.col("ts")))
    out = upsert_stream(lines, f"{base}/bars", ["grain", "symbol", "ts"], ["grain", "month"], prepare=prepare)
    landed = spark.read.parquet(f"{base}/landed").filter(F.col("rejected").cast("string") == "true")
    return out.drop("month"), landed.select(F.col("_file").alias("file"), F.col("_line").alias("line"), "reasons", "symbol", "ts")
