"""The distributed series kernels against straightforward references."""

import datetime as dt

import pytest

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from barspark.functions.series import blocked, block_window, index_series
from barspark.operators.features import features
from bar_by_bar import indicators

COLS = ["volatility", "daily_return", "sma_20", "sma_50", "ema_20", "rsi_14", "macd_line",
        "macd_signal", "macd_hist", "bb_upper", "bb_middle", "bb_lower", "bb_bandwidth"]


def _bars(spark, series: dict[str, list[float]], grain="1d"):
    rows = []
    for sym, closes in series.items():
        t0 = dt.datetime(2020, 1, 1)
        for i, c in enumerate(None if x is None else float(x) for x in closes):
            ts = t0 + (dt.timedelta(days=i) if grain == "1d" else dt.timedelta(hours=i))
            rows.append((sym, grain, ts, ts.date(), c, None if c is None else c * 1.01,
                         None if c is None else c * 0.99, c, None, 100 + i))
    return spark.createDataFrame(
        rows, "symbol string, grain string, ts timestamp_ntz, date date, open double, high double, "
              "low double, close double, adj_close double, volume bigint")


def _check(spark, series, grain="1d", block=None, tol=1e-9):
    got = features(_bars(spark, series, grain), grain, block=block, keep_index=True).toPandas()
    for sym, closes in series.items():
        g = got[got.symbol == sym].sort_values("seq").reset_index(drop=True)
        ref = indicators(pd.Series(closes), daily=grain == "1d")
        assert len(g) == len(ref)
        for c in COLS:
            a, b = ref[c].to_numpy(float), g[c].to_numpy(float)
            assert (np.isnan(a) == np.isnan(b)).all(), (sym, c)
            m = ~np.isnan(a)
            assert np.allclose(a[m], b[m], rtol=tol, atol=tol), (sym, c, np.abs(a[m] - b[m]).max())


def test_carries_across_many_blocks(spark):
    # a hot symbol spanning 40 blocks of 64 rows next to a short one
    rng = np.random.default_rng(7)
    hot = list(100 + np.cumsum(rng.normal(0, 1, 2600)))
    _check(spark, {"HOT": hot, "COLD": list(50 + np.cumsum(rng.normal(0, 1, 70)))}, block=64)


def test_default_block_matches_pandas(spark):
    rng = np.random.default_rng(3)
    _check(spark, {"A": list(200 + np.cumsum(rng.normal(0, 2, 3000))), "B": list(10 + rng.random(120))})


def test_intraday_volatility_rule(spark):
    rng = np.random.default_rng(5)
    _check(spark, {"X": list(30 + np.cumsum(rng.normal(0, 0.3, 300)))}, grain="1h", block=64)


def test_index_series_dense_and_dedup(spark):
    rows = [("A", dt.datetime(2021, 1, 1) + dt.timedelta(days=i // 2 if i < 10 else i), float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, v double")
    got = index_series(df, ["symbol"], "ts", F.year("ts"), tiebreak=["v"], dedup=True).toPandas()
    got = got.sort_values("ts")
    assert list(got["_idx"]) == list(range(len(got)))
    # pairs with equal ts keep the first by the tie-break
    assert len(got) == 400 - 5
    assert got.groupby("ts")["v"].min().equals(got.set_index("ts")["v"])


def test_blocked_windows_equal_plain_windows(spark):
    rows = [("K", i, float(i * i % 97)) for i in range(1000)] + [("L", i, float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "symbol string, _idx long, v double")
    df = df.join(df.groupBy("symbol").agg(F.count(F.lit(1)).alias("_len")), "symbol")
    b = blocked(df, ["symbol"], back=9, fwd=2, block=32)
    w = block_window(["symbol"])
    got = (b.withColumns({"s": F.sum("v").over(w.rowsBetween(-9, 0)), "ld": F.lead("v", 2).over(w)})
           .filter("_own").toPandas())
    plain = Window.partitionBy("symbol").orderBy("_idx")
    ref = df.withColumns({"s": F.sum("v").over(plain.rowsBetween(-9, 0)),
                          "ld": F.lead("v", 2).over(plain)}).toPandas()
    m = got.merge(ref, on=["symbol", "_idx"], suffixes=("", "_r"))
    assert len(m) == 1030
    assert np.allclose(m["s"], m["s_r"])
    assert ((m["ld"] == m["ld_r"]) | (m["ld"].isna() & m["ld_r"].isna())).all()


def test_exact_quantiles_match_percentile_with_split_keys(spark):
    from barspark.functions.quantiles import exact_quantiles
    rng = np.random.default_rng(11)
    rows = [("HOT", float(x)) for x in rng.normal(0, 1, 5000)] + \
           [("HOT", 0.5)] * 50 + [("S", float(x)) for x in rng.random(7)] + [("ONE", 3.0), ("S", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = exact_quantiles(df, ["k"], "v", probs, pieces=16).toPandas().set_index("k")
    want = df.groupBy("k").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).toPandas()
    for _, r in want.iterrows():
        for i in range(len(probs)):
            assert got.loc[r.k, f"v_q{i}"] == pytest.approx(r.q[i], rel=1e-12, abs=1e-12), (r.k, i)


def test_fill_carries_across_buckets(spark):
    # nulls from mid-December to mid-January cross the yearly bucket boundary;
    # the leading nulls of the second symbol take its first value (back fill)
    from barspark.operators.clean import fill_prices
    rows = []
    t0 = dt.datetime(2019, 12, 1)
    for i in range(60):
        ts = t0 + dt.timedelta(days=i)
        c = None if 15 <= i < 50 else float(i)
        rows.append(("A", "1d", ts, ts.date(), c, c, c, c, None, 1))
        c2 = None if i < 40 else float(100 + i)
        rows.append(("B", "1d", ts, ts.date(), c2, c2, c2, c2, None, 1))
    df = spark.createDataFrame(rows, "symbol string, grain string, ts timestamp_ntz, date date, open double, "
                                     "high double, low double, close double, adj_close double, volume bigint")
    got = fill_prices(df).orderBy("symbol", "ts").toPandas()
    a = got[got.symbol == "A"].close.tolist()
    b = got[got.symbol == "B"].close.tolist()
    assert a == [float(i) for i in range(15)] + [14.0] * 35 + [float(i) for i in range(50, 60)]
    assert b == [140.0] * 40 + [float(100 + i) for i in range(40, 60)]


def test_features_fill_nulls_like_pandas(spark):
    rng = np.random.default_rng(9)
    closes = list(100 + np.cumsum(rng.normal(0, 1, 300)))
    holes = [None if (i < 3 or 100 <= i < 140 or i % 37 == 0) else c for i, c in enumerate(closes)]
    got = features(_bars(spark, {"N": holes}), "1d", keep_index=True, block=64).toPandas().sort_values("seq")
    filled = pd.Series(holes, dtype=float).ffill().bfill()
    ref = indicators(filled)
    for c in COLS:
        a, b = ref[c].to_numpy(float), got[c].to_numpy(float)
        assert (np.isnan(a) == np.isnan(b)).all(), c
        m = ~np.isnan(a)
        assert np.allclose(a[m], b[m], rtol=1e-9, atol=1e-9), c
