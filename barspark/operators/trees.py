"""Regression trees for every symbol at once: a forest and a boosted model per symbol, grown level by level.

Spark deals the training rows of every symbol to a few groups, one per share
of the forest's trees and one for the boosted rounds, so all models of all
symbols are one job and no symbol waits for another.  A group grows its trees
breadth first over sorted columns: for all nodes of a level and all features
together, running sums give the gain of every cut between two different
values, and the best cut of each node is the tree's.  Cuts are exact (midpoints of
neighbouring values, no histogram) and trees may grow until their leaves are
pure.

A group holds at most ``fit_rows`` rows of its symbol, a documented bound on
what a model is fitted on: symbols with more training rows give every k-th
one.  Predictions run over blocks of rows, which meet the symbol's trees in a
cogroup; neither rows nor models reach the driver.

Edge cases: a symbol whose fit fails is listed with its error and has no
trees, the others are unaffected; constant targets give trees of one leaf;
constant features are never cut; a table without rows has no models.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOREST, BOOSTED = "Random_Forest", "Gradient_Boosting"
#: The reference's settings: 100 fully grown trees; 100 rounds at 0.05 of depth 3.
TREES, ROUNDS, RATE, BOOST_DEPTH = 100, 100, 0.05, 3
#: Rows of a symbol that a model is fitted on at most; groups that share a forest; rows that meet the trees at a time.
FIT_ROWS, SHARES, BLOCK = 50_000, 4, 32_768

MODEL_SCHEMA = ("symbol string, model string, tree int, base double, feature array<int>, threshold array<double>, left array<int>, "
                "right array<int>, value array<double>, importance array<double>, error string")


def grow(x: np.ndarray, order: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int | None = None) -> dict:
    """One least-squares tree.  ``order``: rows sorted by each feature (features x rows); ``w``: whole weights, 0 leaves a row out.

    Node 0 is the root; a leaf has feature -1.  Of equal gains the first
    feature and its smallest threshold win.
    """
    n_features = x.shape[1]
    tree = {"feature": [-1], "threshold": [0.0], "left": [-1], "right": [-1], "value": [0.0]}
    importance = np.zeros(n_features)
    order = order[w[order] > 0].reshape(n_features, -1)
    node, ids = np.zeros(len(y), np.int64), np.zeros(1, np.int64)
    middle = np.average(y, weights=w)
    y = y - middle
    least = 1e-12 * float((w * y * y).sum())
    level = 0
    while True:
        rows = order[0]
        m = len(ids)
        total, weight = np.bincount(node[rows], (w * y)[rows], m), np.bincount(node[rows], w[rows], m)
        for i, v in zip(ids, total / weight + middle):
            tree["value"][i] = float(v)
        if level == depth or order.shape[1] < 2:
            break
        at = np.argsort(node[order], axis=1, kind="stable")
        order = np.take_along_axis(order, at, 1)
        of = node[order[0]]  # the nodes' rows stand side by side, in the same places for every feature
        first = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1])
        before = lambda c: (np.cumsum(c) - c)[of]
        wl = np.cumsum(w[order], axis=1) - before(weight)
        sl = np.cumsum((w * y)[order], axis=1) - before(total)
        values = np.take_along_axis(x.T, order, 1)
        cut = np.zeros(order.shape, bool)
        cut[:, :-1] = (of[:-1] == of[1:]) & (values[:, :-1] < values[:, 1:])
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(cut, sl ** 2 / wl + (total[of] - sl) ** 2 / (weight[of] - wl) - (total ** 2 / weight)[of], -np.inf)
        best = np.maximum.reduceat(gain, first, axis=1)
        feature = (best >= best.max(0) - least).argmax(0)  # gains that differ by rounding only are equal
        best = best[feature, np.arange(m)]
        split = best > least
        if not split.any():
            break
        hit = np.flatnonzero((gain[feature[of], np.arange(len(of))] >= best[of] - least) & split[of])
        nodes, k = np.unique(of[hit], return_index=True)
        place, f = hit[k], feature[nodes]
        low, high = values[f, place], values[f, place + 1]
        threshold = np.where((low + high) / 2 < high, (low + high) / 2, low)
        importance += np.bincount(f, best[nodes], n_features)
        new = len(tree["feature"]) + np.arange(2 * len(nodes))
        for j, (i, fi, t) in enumerate(zip(ids[nodes], f, threshold)):
            tree["feature"][i], tree["threshold"][i], tree["left"][i], tree["right"][i] = int(fi), float(t), int(new[2 * j]), int(new[2 * j + 1])
        for key, empty in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", 0.0)):
            tree[key] += [empty] * len(new)
        rank = np.full(m, -1)
        rank[nodes] = np.arange(len(nodes))
        mine = rank[node[rows]]
        rows, mine = rows[mine >= 0], mine[mine >= 0]
        node[order[0]] = -1
        node[rows] = 2 * mine + (x[rows, f[mine]] > threshold[mine])
        order = order[node[order] >= 0].reshape(n_features, -1)
        ids = new
        level += 1
    return tree | {"importance": (importance / w.sum()).tolist()}


def leaf(tree: dict, x: np.ndarray) -> np.ndarray:
    """Leaf value of every row."""
    feature, threshold, left, right, value = (np.asarray(tree[k]) for k in ("feature", "threshold", "left", "right", "value"))
    at = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    while True:
        inner = feature[at] >= 0
        if not inner.any():
            return value[at]
        down = np.where(x[rows, np.maximum(feature[at], 0)] <= threshold[at], left[at], right[at])
        at = np.where(inner, down, at)


def forest_trees(x, y, which, symbol: str, trees: int, depth: int | None, seed: int):
    """The asked trees of a forest on rows drawn with replacement; values are shares of the mean over all trees."""
    order = np.argsort(x, axis=0, kind="stable").T
    for t in which:
        draw = np.random.default_rng([seed, t, zlib.crc32(symbol.encode())]).integers(0, len(y), len(y))
        tree = grow(x, order, y, np.bincount(draw, minlength=len(y)).astype(float), depth)
        yield t, 0.0, tree | {"value": [v / trees for v in tree["value"]]}


def boosted_trees(x, y, rounds: int, rate: float, depth: int):
    """Trees on what the ones before leave over, from the mean on."""
    order, w = np.argsort(x, axis=0, kind="stable").T, np.ones(len(y))
    base = float(y.mean())
    now = np.full(len(y), base)
    for t in range(rounds):
        tree = grow(x, order, y - now, w, depth)
        tree["value"] = [rate * v for v in tree["value"]]
        now = now + leaf(tree, x)
        yield t, base if t == 0 else 0.0, tree


def _fit(feats: list[str], trees: int, depth: int | None, rounds: int, rate: float, boost_depth: int, shares: int, seed: int):
    schema = pa.schema([("symbol", pa.string()), ("model", pa.string()), ("tree", pa.int32()), ("base", pa.float64()),
                        ("feature", pa.list_(pa.int32())), ("threshold", pa.list_(pa.float64())), ("left", pa.list_(pa.int32())),
                        ("right", pa.list_(pa.int32())), ("value", pa.list_(pa.float64())), ("importance", pa.list_(pa.float64())),
                        ("error", pa.string())])

    def run(key, rows):
        symbol, share = key[0].as_py(), key[1].as_py()
        model = BOOSTED if share < 0 else FOREST
        try:
            rows = rows.sort_by("split_rank")
            x = np.stack([rows.column(c).to_numpy().astype(float) for c in feats], 1)
            y = rows.column("target_close").to_numpy().astype(float)
            if not (np.isfinite(x).all() and np.isfinite(y).all()):
                raise ValueError("features or target are not finite")
            grown = (boosted_trees(x, y, rounds, rate, boost_depth) if share < 0
                     else forest_trees(x, y, range(share, trees, shares), symbol, trees, depth, seed))
            out = [{"symbol": symbol, "model": model, "tree": t, "base": base, "error": None, **tree} for t, base, tree in grown]
        except Exception as e:  # recorded: one symbol's failure does not stop the others
            out = [{"symbol": symbol, "model": model, "tree": -1, "error": f"{type(e).__name__}: {e}"}]
        return pa.Table.from_pylist(out, schema=schema)
    return run


def fit_symbol_trees(train: DataFrame, feats: list[str], trees: int = TREES, depth: int | None = None, rounds: int = ROUNDS,
                     rate: float = RATE, boost_depth: int = BOOST_DEPTH, fit_rows: int = FIT_ROWS, shares: int = SHARES,
                     seed: int = 42) -> DataFrame:
    """Training rows (symbol, split_rank from 0, n_fit rows of the symbol, features, target_close) -> trees (``MODEL_SCHEMA``)."""
    k, n = F.lit(fit_rows), F.col("n_fit")
    chosen = (n <= k) | (F.floor((F.col("split_rank") + 1) * k / n) > F.floor(F.col("split_rank") * k / n))
    dealt = train.where(chosen).select("symbol", "split_rank", *[F.col(c).cast("double").alias(c) for c in feats], "target_close",
                                       F.explode(F.array(*[F.lit(i) for i in range(-1, min(shares, trees))])).alias("share"))
    return dealt.groupBy("symbol", "share").applyInArrow(
        _fit(feats, trees, depth, rounds, rate, boost_depth, min(shares, trees), seed), MODEL_SCHEMA)


def predict(rows: DataFrame, models: DataFrame, feats: list[str]) -> DataFrame:
    """``rows`` once per tree model of their symbol, with ``model`` and ``prediction``."""
    out_schema = T.StructType([*rows.schema.fields, T.StructField("model", T.StringType()), T.StructField("prediction", T.DoubleType())])
    blk = F.floor(F.col("seq") / BLOCK) if "seq" in rows.columns else F.lit(0).cast("long")
    keyed = rows.withColumn("_blk", blk)
    good = models.where("error IS NULL").select("symbol", "model", "tree", "base", "feature", "threshold", "left", "right", "value")
    blocks = keyed.select("symbol", "_blk").distinct().withColumnsRenamed({"symbol": "_sym", "_blk": "_b"})
    dealt = blocks.join(good, F.col("_sym") == F.col("symbol")).select("_sym", "_b", *good.columns[1:])
    names = rows.columns

    def run(key, left, right):
        x = np.stack([left.column(c).to_numpy(zero_copy_only=False).astype(float) if left.num_rows else np.empty(0) for c in feats], 1)
        left = left.select(names)
        total: dict[str, np.ndarray] = {}
        for batch in right.to_batches():
            lists = {k: batch.column(k) for k in ("feature", "threshold", "left", "right", "value")}
            ends = lists["feature"].offsets.to_numpy()  # the five lists of a tree are equally long
            flat = {k: c.values.to_numpy() for k, c in lists.items()}
            for i, (model, base) in enumerate(zip(batch.column("model").to_pylist(), batch.column("base").to_pylist())):
                tree = {k: v[ends[i]:ends[i + 1]] for k, v in flat.items()}
                total[model] = total.get(model, np.zeros(len(x))) + base + leaf(tree, x)
        parts = [left.append_column("model", pa.array([m] * len(x), pa.string())).append_column("prediction", pa.array(p, pa.float64()))
                 for m, p in sorted(total.items())]
        return pa.concat_tables(parts) if parts else left.slice(0, 0).append_column("model", pa.array([], pa.string())) \
            .append_column("prediction", pa.array([], pa.float64()))

    return keyed.groupBy("symbol", "_blk").cogroup(dealt.groupBy("_sym", "_b")).applyInArrow(run, out_schema)


def importances(models: DataFrame, feats: list[str]) -> DataFrame:
    """(symbol, model, feature, importance), adding up to 1 per model.

    A forest's trees count alike; a boosted model's trees count by the
    variance that they take away.
    """
    t = models.where("error IS NULL").select("symbol", "model", "importance", F.aggregate(
        "importance", F.lit(0.0), lambda a, b: a + b).alias("whole"))
    scale = F.when(F.col("model") == FOREST, F.nullif(F.col("whole"), F.lit(0.0))).otherwise(F.lit(1.0))
    each = t.select("symbol", "model", scale.alias("scale"), F.posexplode("importance").alias("i", "v"))
    s = each.groupBy("symbol", "model", "i").agg(F.sum(F.coalesce(F.try_divide("v", "scale"), F.lit(0.0))).alias("v"))
    whole = s.groupBy("symbol", "model").agg(F.sum("v").alias("whole"))
    name = F.get(F.array(*[F.lit(f) for f in feats]), F.col("i"))
    return s.join(whole, ["symbol", "model"]).select("symbol", "model", name.alias("feature"),
                                                     F.coalesce(F.try_divide("v", "whole"), F.lit(0.0)).alias("importance"))
