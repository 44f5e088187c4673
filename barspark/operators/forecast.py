"""Next-bar close forecasting per symbol (lag features, chronological split,
three regressors, hold-out metrics, best-model choice, next-bar forecast).

Features and the split are pure DataFrame plans (halo-block windows, the
distributed series index).  The linear model is solved from per-symbol
normal equations: the cross-product sums of standardised features are one
``groupBy`` aggregation over all symbols, and only the small per-symbol
matrices are solved (``applyInPandas`` on one row per symbol).  Every symbol
has a forest and a boosted model of its own, all grown in one job
(``operators/trees.py``).  The best model of each symbol by test R2 makes its
forecast and its backtest.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barspark.functions.scalar import round_half
from barspark.functions.series import block_window, blocked, default_bucket, index_series
from barspark.operators.dashboard import last_bars, range_filter
from barspark.operators.trees import fit_symbol_trees, importances, predict
from barspark.session import materialize

LAGS = (1, 2, 3, 5)
MIN_TRAIN_ROWS = 100
TRAIN_SHARE = 0.8
MODEL_ORDER = ["Linear_Regression", "Random_Forest", "Gradient_Boosting"]

BASE_FEATURES = ["close", "volume", "daily_return", "volatility", "sma_20", "sma_50", "ema_20",
                 "rsi_14", "macd_line", "macd_signal", "macd_hist", "bb_upper", "bb_middle",
                 "bb_lower", "bb_bandwidth"]


def feature_names(grain: str = "1d") -> list[str]:
    """The 27 regressors in the reference's order (intraday has no 20-bar volatility)."""
    base = [c for c in BASE_FEATURES if grain == "1d" or c != "volatility"]
    lagged = [f"{p}_lag_{n}" for n in LAGS for p in ("close", "volume", "return")]
    return base + lagged


def lag_features(fact: DataFrame) -> DataFrame:
    """Lags 1,2,3,5 of close, volume, return and the target (next close), on halo
    blocks of the ``seq`` numbering."""
    keys = ["symbol"]
    d = blocked(fact.withColumnsRenamed({"seq": "_idx", "n_bars": "_len"}), keys, back=max(LAGS), fwd=1)
    w = block_window(keys)
    cols = {}
    for n in LAGS:
        cols[f"close_lag_{n}"] = F.lag("close", n).over(w)
        cols[f"volume_lag_{n}"] = F.lag("volume", n).over(w).cast("double")
        cols[f"return_lag_{n}"] = F.lag("daily_return", n).over(w)
    cols["target_close"] = F.lead("close", 1).over(w)
    cols["target_date"] = F.lead("date", 1).over(w)
    out = d.withColumns(cols).filter("_own")
    return out.withColumnsRenamed({"_idx": "seq", "_len": "n_bars"}).drop("_blk", "_own", "_pos")


def training_rows(fact: DataFrame, grain: str = "1d") -> DataFrame:
    """Rows with every feature and the target present, ranked per symbol
    (``split_rank``), with the symbol's count ``n_train_rows``, ``eligible``
    (>= 100 rows) and ``is_test`` (rank >= floor(0.8 n))."""
    feats = feature_names(grain)
    lf = lag_features(fact)
    ok = lf.dropna("any", subset=feats + ["target_close"])
    ranked = index_series(ok, ["symbol"], "date" if grain == "1d" else "ts",
                          default_bucket(grain, "ts"), dedup=False)
    return (ranked.withColumnsRenamed({"_idx": "split_rank", "_len": "n_train_rows"})
            .withColumn("eligible", F.col("n_train_rows") >= MIN_TRAIN_ROWS)
            .withColumn("is_test", F.col("split_rank") >= F.floor(F.col("n_train_rows") * TRAIN_SHARE)))


def latest_vector(fact: DataFrame, grain: str = "1d") -> DataFrame:
    """The last bar's feature vector per symbol (may hold nulls on short series)."""
    lf = lag_features(last_bars(fact, max(LAGS) + 1))
    return last_bars(lf, 1).select("symbol", "date", "ts", *feature_names(grain))


# ------------------------------------------------------------------ metrics

def regression_metrics(where: Column | None = None, prefix: str = "") -> list[Column]:
    """Aggregates mae, rmse, r2 of (target_close, prediction) rows, of those that ``where`` holds for."""
    keep = (lambda c: c) if where is None else (lambda c: F.when(where, c))
    e, y = keep(F.col("target_close") - F.col("prediction")), keep(F.col("target_close"))
    r2 = 1 - F.try_divide(F.sum(e * e), F.var_pop(y) * F.count(y))
    return [F.avg(F.abs(e)).alias(f"{prefix}mae"), F.sqrt(F.avg(e * e)).alias(f"{prefix}rmse"), r2.alias(f"{prefix}r2")]


def metrics_by_split(preds: DataFrame) -> DataFrame:
    """Test MAE/RMSE/R2 and train MAE/R2 per (symbol, model): one pass over the predictions."""
    test = regression_metrics(F.col("is_test"), "test_")
    train = regression_metrics(~F.col("is_test"), "train_")
    m = preds.groupBy("symbol", "model").agg(*test, *train)
    return m.select("symbol", "model", *[round_half(c, 6).alias(c) for c in ("test_mae", "test_rmse", "test_r2", "train_mae", "train_r2")])


def best_model(metrics: DataFrame) -> DataFrame:
    """Highest test R2 wins, the earlier model on ties; if the best R2 is negative
    the linear model is chosen.  ``metrics``: symbol, model, test_r2."""
    order = F.array_position(F.array(*[F.lit(m) for m in MODEL_ORDER]), F.col("model"))
    best = metrics.groupBy("symbol").agg(
        F.max_by(F.struct("model", "test_r2"), F.struct(F.col("test_r2"), -order)).alias("_b"))
    lin = metrics.filter(F.col("model") == MODEL_ORDER[0]).select("symbol", F.col("test_r2").alias("_lin"))
    b = best.join(lin, "symbol", "left")
    neg = F.col("_b.test_r2") < 0
    return b.select("symbol", F.when(neg, F.lit(MODEL_ORDER[0])).otherwise(F.col("_b.model")).alias("best_model"),
                    F.when(neg, F.col("_lin")).otherwise(F.col("_b.test_r2")).alias("best_test_r2"))


# ------------------------------------------------------------------ linear model

def linear_fit(train: DataFrame, feats: list[str]) -> DataFrame:
    """Least squares per symbol: (symbol, mu array, sd array, coef array incl. intercept).

    Means/stds and the cross products of standardised features are two
    aggregations over all symbols; the (p+1)^2 matrices are solved with a
    pseudo-inverse (collinear features such as ``macd_hist`` are allowed)."""
    p = len(feats)
    stats = train.groupBy("symbol").agg(
        F.array(*[F.avg(c) for c in feats]).alias("mu"),
        F.array(*[F.stddev_pop(c) for c in feats]).alias("sd"))
    z = train.join(stats, "symbol")
    zc = [F.coalesce(F.try_divide(F.col(c) - F.col("mu")[i], F.col("sd")[i]), F.lit(0.0)) for i, c in enumerate(feats)]
    z = z.select("symbol", "mu", "sd", F.col("target_close").alias("y"), *[v.alias(f"_z{i}") for i, v in enumerate(zc)])
    terms = [F.lit(1.0)] + [F.col(f"_z{i}") for i in range(p)]
    sums = []
    for i in range(p + 1):
        for j in range(i, p + 1):
            sums.append(F.sum(terms[i] * terms[j]))
    sums += [F.sum(t * F.col("y")) for t in terms]
    agg = z.groupBy("symbol", "mu", "sd").agg(F.array(*sums).alias("_s"))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, row in pdf.iterrows():
            s = np.asarray(row["_s"], dtype=float)
            m = p + 1
            xtx = np.zeros((m, m))
            k = 0
            for i in range(m):
                for j in range(i, m):
                    xtx[i, j] = xtx[j, i] = s[k]
                    k += 1
            xty = s[k:k + m]
            coef = np.linalg.pinv(xtx, rcond=1e-12, hermitian=True) @ xty
            out.append((row["symbol"], list(row["mu"]), list(row["sd"]), coef.tolist()))
        return pd.DataFrame(out, columns=["symbol", "mu", "sd", "coef"])

    schema = T.StructType([T.StructField("symbol", T.StringType()),
                           T.StructField("mu", T.ArrayType(T.DoubleType())),
                           T.StructField("sd", T.ArrayType(T.DoubleType())),
                           T.StructField("coef", T.ArrayType(T.DoubleType()))])
    return agg.groupBy("symbol").applyInPandas(solve, schema)


def linear_predict(rows: DataFrame, model: DataFrame, feats: list[str]) -> DataFrame:
    d = rows.join(model, "symbol")
    pred = F.col("coef")[0]
    for i, c in enumerate(feats):
        zi = F.coalesce(F.try_divide(F.col(c) - F.col("mu")[i], F.col("sd")[i]), F.lit(0.0))
        pred = pred + F.col("coef")[i + 1] * zi
    return d.withColumn("prediction", pred).drop("mu", "sd", "coef")


# ------------------------------------------------------------------ models of all symbols

@dataclass
class Forecasters:
    """Fitted forecasting state: the split table, the linear models and the trees, all materialized, one model per symbol."""
    grain: str
    feats: list[str]
    split: DataFrame | None
    linear: DataFrame
    trees: DataFrame | None = None          # trees.MODEL_SCHEMA

    @property
    def failures(self) -> DataFrame | None:
        """(symbol, model, error) of fits that failed."""
        return None if self.trees is None else self.trees.where("error IS NOT NULL").select("symbol", "model", "error").distinct()


def fit_forecasters(fact: DataFrame, grain: str = "1d", trees: bool = True, **settings) -> Forecasters:
    """The linear model, the forest and the boosted model of every eligible symbol (``trees=False``: the linear ones only).

    ``settings`` go to ``trees.fit_symbol_trees``: number and depth of trees, rounds, rate, rows a model is fitted on at most."""
    feats = feature_names(grain)
    split = materialize(training_rows(fact, grain).filter("eligible")
                        .select("symbol", "date", "ts", "seq", "n_bars", "split_rank", "n_train_rows", "target_date",
                                "is_test", "close", *[c for c in feats if c != "close"], "target_close"),
                        f"forecast_split_{grain}")
    train = split.filter(~F.col("is_test"))
    linear = materialize(linear_fit(train, feats), f"forecast_linear_{grain}")
    fc = Forecasters(grain, feats, split, linear)
    if trees:
        train = train.withColumn("n_fit", F.floor(F.col("n_train_rows") * TRAIN_SHARE))
        fc.trees = materialize(fit_symbol_trees(train, feats, **settings), f"forecast_trees_{grain}")
    return fc


def predict_all(fc: Forecasters, rows: DataFrame, best: DataFrame | None = None) -> DataFrame:
    """``rows`` once per fitted model of their symbol, with ``model`` and ``prediction``; with ``best``
    (symbol, best_model) only of the named model of each symbol."""
    linear, grown = fc.linear, fc.trees
    if best is not None:
        linear = linear.join(best.where(F.col("best_model") == MODEL_ORDER[0]), "symbol", "left_semi")
        named = best.select("symbol", F.col("best_model").alias("model"))
        grown = None if grown is None else grown.join(named, ["symbol", "model"], "left_semi")
    out = linear_predict(rows, linear, fc.feats).withColumn("model", F.lit(MODEL_ORDER[0]))
    out = out.select(*rows.columns, "model", "prediction")
    return out if grown is None else out.unionByName(predict(rows, grown, fc.feats))


def forecast_predictions(fc: Forecasters) -> DataFrame:
    """(symbol, model, is_test, target_close, prediction) of every fitted regressor."""
    return predict_all(fc, fc.split).select("symbol", "model", "is_test", "target_close", "prediction")


def forecast_metrics(fc: Forecasters) -> DataFrame:
    """Test MAE/RMSE/R2 and train MAE/R2 per (symbol, model) for eligible symbols."""
    return metrics_by_split(forecast_predictions(fc))


def training_summary(fact: DataFrame, grain: str = "1d", failures: DataFrame | None = None) -> DataFrame:
    """One row per symbol: usable rows, and whether it is trained, skipped (too few rows) or failed."""
    rows = training_rows(fact, grain).groupBy("symbol").agg(F.max("n_train_rows").alias("n_train_rows"))
    out = fact.select("symbol").distinct().join(rows, "symbol", "left").withColumn("n_train_rows", F.coalesce("n_train_rows", F.lit(0)).cast("long"))
    if failures is None:
        failures = fact.sparkSession.createDataFrame([], "symbol string, model string, error string")
    failed = failures.groupBy("symbol").agg(F.array_join(F.sort_array(F.collect_set(  # two models a symbol at most
        F.concat("model", F.lit(": "), "error"))), "; ").alias("error"))
    return out.join(failed, "symbol", "left").select(
        "symbol", "n_train_rows", F.when(F.col("n_train_rows") < MIN_TRAIN_ROWS, "skipped").when(F.col("error").isNotNull(), "failed")
        .otherwise("trained").alias("status"), "error")


def forecast_next(fc: Forecasters, fact: DataFrame, best: DataFrame) -> DataFrame:
    """Next-bar forecast from each symbol's best model: forecast, diff and % diff vs the last close."""
    last = latest_vector(fact, fc.grain).dropna("any", subset=fc.feats)
    p = predict_all(fc, last, best)
    return p.select("symbol", "date", "model", round_half("close").alias("last_close"),
                    round_half("prediction").alias("forecast_close"),
                    round_half(F.col("prediction") - F.col("close")).alias("forecast_diff"),
                    round_half(F.try_divide(F.col("prediction") - F.col("close"), F.col("close")) * 100)
                    .alias("forecast_pct"))


def backtest(fc: Forecasters, best: DataFrame, start=None, end=None) -> DataFrame:
    """Actual vs predicted next close of each symbol's best model over the chosen range of dates (by default
    the dashboard's: the last 365 bars), with the date the prediction is for and the split flag."""
    rows = range_filter(fc.split, start, end)
    p = predict_all(fc, rows, best)
    return p.select("symbol", "date", "target_date", "model", "is_test", round_half("target_close").alias("actual_close"),
                    round_half("prediction").alias("predicted_close"))


def feature_importance(fc: Forecasters, best: DataFrame, top: int = 10) -> DataFrame:
    """Top feature importances of each symbol's best model where that is a tree model: of that symbol's own trees."""
    return top_features(importances(fc.trees, fc.feats), best, top)


def top_features(imp: DataFrame, best: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` rows of (symbol, model, feature, importance) for every symbol's best model."""
    w = Window.partitionBy("symbol").orderBy(F.desc("importance"), "feature")
    j = imp.join(best.select("symbol", F.col("best_model").alias("model")), ["symbol", "model"])
    return j.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top).select("symbol", "model", "rank", "feature", "importance")


def save_forecasters(fc: Forecasters, path: str, fact: DataFrame, best: DataFrame) -> None:
    """Persist the fitted state as tables: the linear coefficients, the trees, the feature list, the latest
    vectors and the best model per symbol."""
    spark = fc.linear.sparkSession
    fc.linear.write.mode("overwrite").parquet(f"{path}/linear")
    if fc.trees is not None:
        fc.trees.write.mode("overwrite").parquet(f"{path}/trees")
    latest_vector(fact, fc.grain).write.mode("overwrite").parquet(f"{path}/latest")
    best.write.mode("overwrite").parquet(f"{path}/best")
    spark.createDataFrame([(i, c, fc.grain, fc.trees is not None) for i, c in enumerate(fc.feats)],
                          "position int, feature string, grain string, has_trees boolean").write.mode("overwrite").parquet(f"{path}/features")


def load_forecasters(spark, path: str) -> tuple[Forecasters, DataFrame, DataFrame]:
    """What ``save_forecasters`` stored: the models (without the split table), the latest vectors and the best models."""
    feats = spark.read.parquet(f"{path}/features").orderBy("position").collect()
    trees = spark.read.parquet(f"{path}/trees") if feats[0].has_trees else None
    fc = Forecasters(feats[0].grain, [r.feature for r in feats], None, spark.read.parquet(f"{path}/linear"), trees)
    return fc, spark.read.parquet(f"{path}/latest"), spark.read.parquet(f"{path}/best")
