"""Bar sources: OHLCV bars from ticks / line items, vendor bar files, the dimension.

All symbols are read and aggregated in one job; bar aggregation is a
``groupBy`` with map-side partial aggregation (``min_by``/``max_by`` carry a
struct tie-break so the open/close of a bar is deterministic).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barspark.sources.tables import table

# bar interval name -> date_trunc unit (other intervals go through F.window)
_TRUNC_UNITS = {"1m": "minute", "1h": "hour", "1d": "day"}


def bucket_start(ts: Column, interval: str) -> Column:
    """Start of the bar interval containing ``ts`` (TIMESTAMP_NTZ in, NTZ out)."""
    unit = _TRUNC_UNITS.get(interval)
    if unit is not None:
        return F.date_trunc(unit, ts).cast("timestamp_ntz")
    return F.window(ts.cast("timestamp"), interval).start.cast("timestamp_ntz")


def packed_order(ts: Column, number: Column) -> Column:
    """(time, number) as one decimal of the same order: microseconds times 2**64 plus the number moved to be non-negative."""
    wide = lambda c: c.cast("decimal(20,0)")
    low = F.coalesce(wide(number) + F.lit(Decimal(1 << 63)), F.lit(Decimal(0)))
    return (F.unix_micros(ts.cast("timestamp")).cast("decimal(18,0)") * F.lit(Decimal(1 << 64)) + low).cast("decimal(38,0)")


def bars_from_ticks(ticks: DataFrame, interval: str, symbol: str = "symbol",
                    ts: str = "ts", price: str = "price", size: str | None = None,
                    tiebreak: list[str] | None = None) -> DataFrame:
    """Aggregate ticks into OHLCV bars per (symbol, interval).

    open/close are the price at the first/last tick by (ts, *tiebreak);
    volume is the summed ``size`` (tick count when ``size`` is None).  One
    whole-number tie-break is packed with the time into one fixed-width
    number, which keeps the aggregation a hash aggregation without a sort.
    """
    if tiebreak and len(tiebreak) == 1 and isinstance(ticks.schema[tiebreak[0]].dataType, T.IntegralType):
        order = packed_order(F.col(ts), F.col(tiebreak[0]))
    else:
        order = F.struct(F.col(ts), *[F.col(c) for c in tiebreak]) if tiebreak else F.col(ts)
    vol = F.count(F.lit(1)) if size is None else F.sum(size).cast("bigint")
    start = bucket_start(F.col(ts), interval)
    return (ticks
            .groupBy(F.col(symbol).alias("symbol"), start.alias("ts"))
            .agg(F.min_by(price, order).alias("open"), F.max(price).alias("high"),
                 F.min(price).alias("low"), F.max_by(price, order).alias("close"),
                 vol.alias("volume"))
            .select("symbol", F.lit(interval).alias("grain"), "ts",
                    F.to_date("ts").alias("date"), "open", "high", "low", "close",
                    F.lit(None).cast("double").alias("adj_close"), "volume"))


def symbol_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as price ticks: symbol = supplier nation name, price = unit price.

    nation has a fixed 25 rows, so it is broadcast; supplier grows with the
    data and is joined by whatever AQE measures at run time.
    """
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    supp = table(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey")
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey",
               "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    # line items meet supplier first (supplier is broadcast only when its
    # estimated size allows, otherwise both sides shuffle on the key), then the
    # fixed-size nation table is broadcast
    return (li.join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_name").alias("symbol"), F.col("l_shipdate").alias("ts"),
                    F.try_divide("l_extendedprice", "l_quantity").alias("price"),
                    "l_quantity", "l_orderkey", "l_linenumber", "l_partkey",
                    "l_suppkey", "l_extendedprice"))


LINE_TIEBREAK = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                 "l_quantity", "l_extendedprice"]


def bars_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars (grain '1d') per nation from line items.

    open/close = unit price of the first/last line of the day by the
    six-column line key; volume = summed quantity.
    """
    lines = symbol_lines(spark, sf_dir)
    key = F.struct(*[F.col(c) for c in LINE_TIEBREAK])
    return (lines.groupBy("symbol", F.to_date("ts").alias("date"))
            .agg(F.min_by("price", key).alias("open"), F.max("price").alias("high"),
                 F.min("price").alias("low"), F.max_by("price", key).alias("close"),
                 F.sum("l_quantity").cast("bigint").alias("volume"))
            .select("symbol", F.lit("1d").alias("grain"),
                    F.col("date").cast("timestamp_ntz").alias("ts"), "date",
                    "open", "high", "low", "close",
                    F.lit(None).cast("double").alias("adj_close"), "volume"))


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a tick stream: symbol = event_type, price = value."""
    return (table(spark, sf_dir, "events", "event_type", "ts", "value", "event_id")
            .select(F.col("event_type").alias("symbol"), "ts", F.col("value").alias("price"), "event_id"))


def bars_intraday(spark: SparkSession, sf_dir: str, interval: str = "1h") -> DataFrame:
    """Intraday bars from the events table (tick count as volume); ticks of one time are told apart by event_id."""
    return bars_from_ticks(event_ticks(spark, sf_dir), interval, tiebreak=["event_id"])


def dim_from_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimension rows: symbol = company = nation name, sector = region name."""
    n = table(spark, sf_dir, "nation", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return (n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_name").alias("symbol"), F.col("n_name").alias("company_name"),
                    F.col("r_name").alias("sector"),
                    F.lit(None).cast("string").alias("industry"),
                    F.lit(None).cast("string").alias("exchange")))


# ---------------------------------------------------------------- vendor files

VENDOR_SCHEMA = T.StructType([
    T.StructField("Date", T.StringType()), T.StructField("Datetime", T.StringType()),
    T.StructField("Open", T.DoubleType()), T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()), T.StructField("Close", T.DoubleType()),
    T.StructField("Adj Close", T.DoubleType()), T.StructField("Volume", T.LongType()),
    T.StructField("Dividends", T.DoubleType()), T.StructField("Stock Splits", T.DoubleType()),
    T.StructField("Ticker", T.StringType()),
])


def existing_paths(spark: SparkSession, paths: list[str] | str) -> tuple[list[str], list[str]]:
    """Paths (or patterns) that match something, and those that do not."""
    found, missing = [], []
    for p in [paths] if isinstance(paths, str) else list(paths):
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        hits = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        (found if hits is not None and len(hits) else missing).append(p)
    return found, missing


def text_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines of text files with the file each comes from."""
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("_file"))


def _by_header(lines: DataFrame) -> DataFrame:
    """Lines of CSV files of any mix of headers as one table of texts, columns taken by name, with ``_file`` and ``_line``.

    A file's header is its line that names the vendor columns; files are
    told apart by header, of which there are few (only the distinct headers reach the driver).
    Lines of a file without a header have no columns."""
    names = F.array(*[F.lit(f.name) for f in VENDOR_SCHEMA.fields])
    cells = F.transform(F.split("value", ","), lambda c: F.trim(F.replace(c, F.lit('"'), F.lit(""))))
    is_header = F.size(F.array_intersect(cells, names)) >= 3
    lines = lines.withColumn("_is_header", is_header).filter(F.length("value") > 0)
    headers = lines.filter("_is_header").groupBy("_file").agg(F.first("value").alias("_header"))
    body = lines.filter(~F.col("_is_header")).join(headers, "_file", "left")
    known = {f.name: i for i, f in reversed(list(enumerate(VENDOR_SCHEMA.fields)))}
    out = body.filter(F.col("_header").isNull()).select(
        "_file", F.col("value").alias("_line"), F.lit(False).alias("_has_header"), *[F.lit(None).cast("string").alias(n) for n in known])
    for row in headers.select("_header").distinct().collect():
        cols = [c.strip().strip('"') for c in row["_header"].split(",")]
        schema = ", ".join(f"c{i} string" for i in range(len(cols)))
        part = body.filter(F.col("_header") == row["_header"]).select("_file", F.col("value").alias("_line"), F.from_csv("value", schema).alias("r"))
        part = part.select("_file", "_line", F.lit(True).alias("_has_header"), *[
            F.col(f"r.c{cols.index(n)}").alias(n) if n in cols else F.lit(None).cast("string").alias(n) for n in known])
        out = out.unionByName(part)
    return out


# Texts that stand for a missing number.
MISSING = ("", "nan", "null", "none", "na", "n/a", "-nan")


def parse_vendor(raw: DataFrame, grain: str) -> DataFrame:
    """Vendor rows as BAR columns, with ``reasons``: why a row cannot be used (empty: it can).

    ``no_header``: the file never names its columns; ``no_symbol``, ``bad_stamp``: missing or unreadable;
    ``bad_<column>``: a price or volume whose text is no number.  Missing numbers and infinities are null and no reason."""
    cols, bad = {}, []
    for f in VENDOR_SCHEMA.fields:
        c = F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None)
        if isinstance(f.dataType, T.StringType):
            cols[f.name] = c.cast("string")
            continue
        text = F.trim(c.cast("string"))
        n = text.try_cast("double")
        bad.append((f"bad_{f.name.lower().replace(' ', '_')}", n.isNull() & ~F.coalesce(F.lower(text), F.lit("")).isin(*MISSING)))
        n = F.when(~F.isnan(n) & (F.abs(n) != float("inf")), n)
        cols[f.name] = F.round(n).try_cast("bigint") if isinstance(f.dataType, T.LongType) else n
    stamp = F.coalesce(cols["Datetime"], cols["Date"])
    ts = F.coalesce(F.try_to_timestamp(stamp), F.try_to_timestamp(F.substring(stamp, 1, 19)))
    headless = ~F.col("_has_header") if "_has_header" in raw.columns else F.lit(False)
    bad = [("no_symbol", F.coalesce(F.trim(cols["Ticker"]), F.lit("")) == ""), ("bad_stamp", ts.isNull()), *bad]
    reasons = F.when(headless, F.array(F.lit("no_header"))).otherwise(F.filter(
        F.array(*[F.when(is_bad, F.lit(name)) for name, is_bad in bad]), lambda r: r.isNotNull()))
    own = [c for c in ("_file", "_line") if c in raw.columns]
    return raw.select(
        cols["Ticker"].alias("symbol"), F.lit(grain).alias("grain"),
        ts.cast("timestamp_ntz").alias("ts"), F.try_to_date(F.substring(stamp, 1, 10)).alias("date"),
        cols["Open"].alias("open"), cols["High"].alias("high"), cols["Low"].alias("low"),
        cols["Close"].alias("close"), cols["Adj Close"].alias("adj_close"), cols["Volume"].alias("volume"),
        reasons.alias("reasons"), *own)


def _raw_vendor(spark: SparkSession, paths: list[str] | str, fmt: str) -> DataFrame:
    found, missing = existing_paths(spark, paths)
    if not found:
        raise FileNotFoundError(f"no bar files at {missing}")
    if fmt == "csv":
        return _by_header(text_lines(spark, found))
    raw = spark.read.format(fmt).load(found)
    return raw.select("*", F.col("_metadata.file_path").alias("_file"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in raw.columns])).alias("_line"))


def read_vendor_bars(spark: SparkSession, paths: list[str] | str, grain: str = "1d",
                     fmt: str = "csv") -> DataFrame:
    """Read vendor bar files of all symbols at once into the BAR layout.

    Paths that match nothing are skipped (``existing_paths`` names them); none at all is an
    error.  CSV columns are taken by each file's own header, so files with
    different columns or orders mix (daily files carry ``Date``, intraday ones
    ``Datetime`` with a UTC offset); absent columns are null.  Values that do not parse,
    NaN and infinities become null and surface in the data-quality checks (``split_vendor_bars`` sets
    such rows aside instead)."""
    parsed = parse_vendor(_raw_vendor(spark, paths, fmt), grain)
    return parsed.filter(~F.array_contains("reasons", "no_header")).drop("reasons", "_file", "_line")


def split_rows(parsed: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Accepted bars and rejected rows of ``parse_vendor``, parted by one write under ``path``.

    Both are folders of one table (``rejected=false`` and ``rejected=true``), so reading one never opens the other.
    A rejected row keeps its file, its line as it stood, what could be read of it and its reasons."""
    spark = parsed.sparkSession
    rejected = F.size("reasons") > 0
    rows = parsed.withColumns({"_line": F.when(rejected, F.col("_line")), "_file": F.when(rejected, F.col("_file")), "rejected": rejected})
    rows.write.mode("overwrite").partitionBy("rejected").parquet(path)
    back = spark.read.schema(T.StructType([f for f in rows.schema.fields])).parquet(path)
    bars = back.filter("NOT rejected").drop("reasons", "_file", "_line", "rejected")
    return bars, back.filter("rejected").select(F.col("_file").alias("file"), F.col("_line").alias("line"), "reasons", "symbol", "grain", "ts")


def split_vendor_bars(spark: SparkSession, paths: list[str] | str, path: str, grain: str = "1d", fmt: str = "csv") -> tuple[DataFrame, DataFrame]:
    """``read_vendor_bars`` with quarantine: accepted bars, and the rejected rows with their reasons, both stored under ``path``."""
    return split_rows(parse_vendor(_raw_vendor(spark, paths, fmt), grain), path)


def reject_counts(rejected: DataFrame) -> DataFrame:
    """Rejected rows by reason (a row with two reasons counts for both)."""
    return rejected.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows"))


def missing_symbols(loaded: DataFrame, wanted: DataFrame) -> DataFrame:
    """Symbols asked for but absent from the loaded bars (left-anti join)."""
    return wanted.select("symbol").distinct().join(loaded.select("symbol").distinct(), "symbol", "left_anti")


def file_stem(symbol: Column, suffix: str) -> Column:
    """Per-symbol file stem: dots become underscores, then ``_<suffix>``."""
    return F.concat(F.translate(symbol, ".", "_"), F.lit("_" + suffix))
