"""Sinks: replace-by-(grain, symbol) load, column mapping, dimension seed."""

import uuid

from pyspark.sql import functions as F

from barspark.plans import pipeline as P
from barspark.session import checkpoint_dir
from barspark.sources.warehouse import fact_table, load_symbol, map_columns, seed_dim, write_facts
from paths import SF_SMALL


def test_replace_by_symbol_is_idempotent_and_keeps_other_grain(spark):
    path = f"{checkpoint_dir(spark)}/wh-{uuid.uuid4().hex[:8]}"
    d, h = P.fact(spark, SF_SMALL, "1d"), P.fact(spark, SF_SMALL, "1h")
    write_facts(d, path)
    n1 = fact_table(spark, path).read().count()
    write_facts(h, path)
    write_facts(d, path)          # re-run of the daily load
    t = fact_table(spark, path).read()
    assert t.filter("grain = '1d'").count() == n1
    assert t.filter("grain = '1h'").count() == h.count()
    sym = d.select("symbol").first()[0]
    one = load_symbol(spark, path, sym, "1d", ["ts", "close"])
    assert one.count() == d.filter(F.col("symbol") == sym).count()


def test_map_columns_defaults(spark):
    df = spark.createDataFrame([("2020-01-01", "A.NS", 1.0, 2, 0.5, "x")],
                               "Date string, Ticker string, Close double, Volume long, Volatility_5m double, Dividends string")
    row = map_columns(df).collect()[0]
    assert row.symbol == "A.NS" and row.close == 1.0 and row.volatility_20d == 0.5
    assert row.Daily_Return_Outlier is False and row.Volume_Outlier is False and row.open is None
    assert "Dividends" not in map_columns(df).columns


def test_seed_dim_replaces(spark):
    path = f"{checkpoint_dir(spark)}/dim-{uuid.uuid4().hex[:8]}"
    assert seed_dim(spark, path).count() == 5
    assert seed_dim(spark, path).count() == 5


def test_missing_symbols_and_local_date(spark):
    import datetime as dt
    from barspark.operators.clean import local_date
    from barspark.sources.bars import missing_symbols
    loaded = spark.createDataFrame([("A",), ("B",)], "symbol string")
    wanted = spark.createDataFrame([("A",), ("C",)], "symbol string")
    assert [r.symbol for r in missing_symbols(loaded, wanted).collect()] == ["C"]
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 2, 0),)], "ts timestamp")
    # 02:00 UTC is still Dec 31 in New York and already Jan 1 in Kolkata
    got = df.select(local_date(F.col("ts"), "America/New_York").alias("ny"),
                    local_date(F.col("ts"), "Asia/Kolkata").alias("in")).collect()[0]
    assert got.ny == dt.date(2023, 12, 31) and got["in"] == dt.date(2024, 1, 1)


def test_forecasters_persist(spark):
    import datetime as dt
    from barspark.operators import forecast
    from barspark.operators.features import features
    rows = []
    for i in range(260):
        ts = dt.datetime(2020, 1, 1) + dt.timedelta(days=i)
        c = float(100 + 0.3 * i + (i % 4))
        rows.append(("S", "1d", ts, ts.date(), c, c, c, c, None, 100 + i))
    bars = spark.createDataFrame(rows, "symbol string, grain string, ts timestamp_ntz, date date, open double, "
                                       "high double, low double, close double, adj_close double, volume bigint")
    f = features(bars, keep_index=True)
    fc = forecast.fit_forecasters(f, depth=3, rounds=3)
    best = spark.createDataFrame([("S", "Gradient_Boosting")], "symbol string, best_model string")
    path = f"{checkpoint_dir(spark)}/models-{uuid.uuid4().hex[:8]}"
    forecast.save_forecasters(fc, path, f, best)
    again, latest, best2 = forecast.load_forecasters(spark, path)
    assert again.feats == forecast.feature_names("1d") and {r.model for r in again.trees.collect()} == {"Random_Forest", "Gradient_Boosting"}
    a = forecast.forecast_next(fc, f, best).collect()
    b = forecast.predict_all(again, latest).join(best2.withColumnRenamed("best_model", "model"), ["symbol", "model"]).collect()
    assert a[0].model == "Gradient_Boosting" and abs(a[0].forecast_close - b[0].prediction) < 1e-3


def test_tree_models_of_many_symbols(spark):
    """Forty symbols: each has models of its own, symbols with few rows are skipped, failures are listed."""
    import datetime as dt
    from barspark.operators import forecast
    from barspark.operators.features import features
    rows = []
    for s in range(40):
        for i in range(160):
            ts = dt.datetime(2020, 1, 1) + dt.timedelta(days=i)
            c = float(50 + s + 0.2 * i + (i * (s + 3)) % 7)
            rows.append((f"S{s:02d}", "1d", ts, ts.date(), c, c + 1, c - 1, c, None, 100 + i))
    rows += [(f"T{i}", "1d", dt.datetime(2020, 1, 1 + i), dt.date(2020, 1, 1 + i), 1.0, 1.0, 1.0, 1.0, None, 1) for i in range(3)]
    f = features(spark.createDataFrame(rows, "symbol string, grain string, ts timestamp_ntz, date date, open double, high double, "
                                             "low double, close double, adj_close double, volume bigint"), keep_index=True)
    fc = forecast.fit_forecasters(f, depth=4, rounds=10, rate=0.3)
    m = forecast.forecast_metrics(fc).collect()
    assert len(m) == 3 * 40
    assert sum(x.train_r2 > 0.5 for x in m if x.model != "Linear_Regression") >= 70
    best = forecast.best_model(spark.createDataFrame(m))
    assert forecast.forecast_next(fc, f, best).count() == 40
    assert forecast.backtest(fc, best, end=dt.date(2020, 5, 1)).count() > 0
    failed = spark.createDataFrame([("S01", "Random_Forest", "boom")], "symbol string, model string, error string")
    got = {x.symbol: x.status for x in forecast.training_summary(f, failures=failed).collect()}
    assert got["S00"] == "trained" and got["S01"] == "failed" and got["T0"] == "skipped"


def test_read_vendor_intraday_with_offsets(spark, tmp_path):
    import datetime as dt
    from barspark.sources.bars import read_vendor_bars
    p = tmp_path / "TCS_NS_realtime.csv"
    p.write_text("Datetime,Open,High,Low,Close,Volume,Dividends,Stock Splits,Ticker\n"
                 "2024-01-02 09:15:00+05:30,10,11,9,10.5,100,0,0,TCS.NS\n"
                 "2024-01-02 09:16:00+05:30,10.5,12,10,11,150,0,0,TCS.NS\n"
                 "not a time,1,1,1,1,x,0,0,TCS.NS\n")
    got = read_vendor_bars(spark, str(p), "1m").orderBy("ts").collect()
    assert got[0].ts is None and got[0].volume is None            # quarantined, not failing the load
    assert got[1].ts == dt.datetime(2024, 1, 2, 3, 45) and got[1].date == dt.date(2024, 1, 2)
    assert got[2].close == 11.0 and got[2].volume == 150 and got[2].symbol == "TCS.NS"


def test_run_etl_from_vendor_files(spark, tmp_path):
    from barspark.plans.pipeline import run_etl
    from barspark.sources.warehouse import write_per_symbol_csv
    b = P.bars(spark, SF_SMALL, "1d")
    vendor = b.select(F.date_format("date", "yyyy-MM-dd").alias("Date"), F.col("open").alias("Open"),
                      F.col("high").alias("High"), F.col("low").alias("Low"), F.col("close").alias("Close"),
                      F.col("volume").alias("Volume"), F.col("symbol").alias("Ticker"), "symbol")
    land = str(tmp_path / "raw")
    write_per_symbol_csv(vendor.unionByName(vendor.limit(3)), land)   # with duplicate rows
    wh = f"{checkpoint_dir(spark)}/etl-{uuid.uuid4().hex[:8]}"
    fact = run_etl(spark, f"{land}/symbol=*/*.csv", wh, "1d", dim_rows=P.dim(spark, SF_SMALL))
    want = P.fact(spark, SF_SMALL, "1d")
    assert fact.count() == want.count()
    j = fact.select("symbol", "date", F.col("rsi_14").alias("a")).join(
        want.select("symbol", "date", F.col("rsi_14").alias("b")), ["symbol", "date"])
    assert j.count() == want.count()
    assert j.filter(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0
    assert spark.read.parquet(f"{wh}/dim").count() == P.dim(spark, SF_SMALL).count()


def test_quarantine_names_every_reason(spark, tmp_path):
    from barspark.sources.bars import read_vendor_bars, reject_counts, split_vendor_bars
    a = ["Date,Open,High,Low,Close,Volume,Ticker", "2024-01-02,1,2,0.5,1.5,10,AAA", "2024-01-03,nan,2,,inf,10,AAA", "soon,1,2,0.5,1.5,10,AAA",
         "2024-01-04,1,2,0.5,1.5.2,lots,AAA", "2024-01-05,1,2,0.5,1.5,10,", ",1,2,0.5,x,10, "]
    (tmp_path / "a.csv").write_text("\n".join(a) + "\n")
    (tmp_path / "b.csv").write_text("2024-01-02,1,2,0.5,1.5,10,BBB\n")
    bars, rejected = split_vendor_bars(spark, str(tmp_path / "*.csv"), str(tmp_path / "out"))
    got = {(r.symbol, str(r.date)): (r.open, r.low, r.close) for r in bars.collect()}
    assert got == {("AAA", "2024-01-02"): (1.0, 0.5, 1.5), ("AAA", "2024-01-03"): (None, None, None)}
    assert {r.line: (r.reasons, r.file.rsplit("/", 1)[1]) for r in rejected.collect()} == {
        a[3]: (["bad_stamp"], "a.csv"), a[4]: (["bad_close", "bad_volume"], "a.csv"), a[5]: (["no_symbol"], "a.csv"),
        a[6]: (["no_symbol", "bad_stamp", "bad_close"], "a.csv"), "2024-01-02,1,2,0.5,1.5,10,BBB": (["no_header"], "b.csv")}
    assert {r.reason: r.n_rows for r in reject_counts(rejected).collect()} == {
        "bad_stamp": 2, "bad_close": 2, "bad_volume": 1, "no_symbol": 2, "no_header": 1}
    assert read_vendor_bars(spark, str(tmp_path / "*.csv")).count() == 6  # all rows of files that name their columns
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "c.csv").write_text(a[0] + "\n" + a[1] + "\n")
    bars, rejected = split_vendor_bars(spark, str(tmp_path / "c" / "*.csv"), str(tmp_path / "clean"))
    assert (bars.count(), rejected.count(), reject_counts(rejected).count()) == (1, 0, 0)


def test_landing_files_over_batches_give_the_batch_result(spark, tmp_path):
    from barspark.sources.bars import read_vendor_bars
    from barspark.streaming.live import stream_vendor_files
    land = tmp_path / "land"
    land.mkdir()
    for i in range(5):
        head = "Datetime,Open,Close,Ticker" if i % 2 else "Ticker,Close,Datetime,Volume"
        line = (lambda m, i=i: f"2024-01-0{i + 1} 10:{m:02d}:00+00:00,1,{m},S" if i % 2 else f"S,{m},2024-01-0{i + 1} 10:{m:02d}:00+00:00,{m}")
        (land / f"{i}.csv").write_text("\n".join([head, *[line(m) for m in range(20)]]) + "\n")
    (land / "bad.csv").write_text("Ticker,Close,Datetime\nS,1,whenever\n")
    out, rejected = stream_vendor_files(spark, f"{land}/*.csv", str(tmp_path / "out"), "1m", files_per_trigger=2)
    cols = ["symbol", "ts", "open", "close", "volume"]
    want = read_vendor_bars(spark, f"{land}/*.csv", "1m").filter("ts IS NOT NULL").select(*cols)
    assert sorted(map(tuple, out.select(*cols).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert out.count() == 100 and [(r.line, r.reasons) for r in rejected.collect()] == [("S,1,whenever", ["bad_stamp"])]
