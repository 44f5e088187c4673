"""Trees per symbol against an exhaustive split search, and their use in forecasts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barspark.operators import trees


def exhaustive(x, y, w, depth):
    """Nested tuples (feature, threshold, left, right) or a leaf value: every cut of every feature tried in turn."""
    def fit(rows, level):
        total, weight = (w[rows] * y[rows]).sum(), w[rows].sum()
        best = (1e-9, None, None)
        for f in range(x.shape[1]):
            values = np.unique(x[rows, f])
            for a, b in zip(values[:-1], values[1:]):
                left = rows[x[rows, f] <= a]
                sl, wl = (w[left] * y[left]).sum(), w[left].sum()
                gain = sl ** 2 / wl + (total - sl) ** 2 / (weight - wl) - total ** 2 / weight
                if gain > best[0] + 1e-9:
                    best = (gain, f, (a + b) / 2)
        if best[1] is None or level == depth:
            return round(float(total / weight), 6)
        go = x[rows, best[1]] <= best[2]
        return best[1], round(float(best[2]), 6), fit(rows[go], level + 1), fit(rows[~go], level + 1)
    return fit(np.flatnonzero(w > 0), 0)


def nested(t, i=0):
    if t["feature"][i] < 0:
        return round(t["value"][i], 6)
    return t["feature"][i], round(t["threshold"][i], 6), nested(t, t["left"][i]), nested(t, t["right"][i])


@pytest.mark.parametrize("seed,depth", [(0, None), (1, None), (2, 3), (3, 1), (4, 0)])
def test_grown_tree_equals_exhaustive_search(seed, depth):
    r = np.random.default_rng(seed)
    x = r.integers(0, 12, (70, 4)).astype(float)
    y = r.integers(-500, 500, 70) * 1.0
    w = np.bincount(r.integers(0, 70, 70), minlength=70).astype(float)
    t = trees.grow(x, np.argsort(x, axis=0, kind="stable").T, y, w, depth)
    assert nested(t) == exhaustive(x, y, w, depth)
    leaves = trees.leaf(t, x)
    if depth is None:  # grown until no cut helps: rows of one leaf share their features
        same = {}
        for i in np.flatnonzero(w > 0):
            same.setdefault(tuple(x[i]), []).append(i)
        for rows in same.values():
            assert leaves[rows] == pytest.approx((w[rows] * y[rows]).sum() / w[rows].sum())


def test_constant_targets_and_features():
    x = np.array([[1.0, 5.0]] * 6)
    one = trees.grow(x, np.argsort(x, axis=0, kind="stable").T, np.arange(6.0), np.ones(6))
    assert one["feature"] == [-1] and one["value"] == [2.5]
    x = np.arange(12.0).reshape(6, 2)
    flat = trees.grow(x, np.argsort(x, axis=0, kind="stable").T, np.full(6, 7.0), np.ones(6))
    assert flat["feature"] == [-1] and flat["value"] == [7.0] and sum(flat["importance"]) == 0


def rows_of(spark, symbols, n=160):
    out = []
    for k, s in enumerate(symbols):
        r = np.random.default_rng(k)
        for i in range(n):
            a, b = float(r.integers(0, 50)), float(r.integers(0, 50))
            out.append((s, i, n, a, b, (3 * a if s == "UP" else 100 - 2 * b) + float(r.integers(0, 3)), i))
    return spark.createDataFrame(out, "symbol string, split_rank long, n_fit long, a double, b double, target_close double, seq long")


def test_every_symbol_has_models_of_its_own(spark):
    train = rows_of(spark, ["UP", "DOWN"])
    m = trees.fit_symbol_trees(train, ["a", "b"], trees=20, rounds=40, rate=0.2).cache()
    assert m.groupBy("symbol", "model").count().count() == 4 and m.where("error IS NOT NULL").count() == 0
    assert sorted(r.tree for r in m.where("symbol = 'UP' AND model = 'Random_Forest'").collect()) == list(range(20))
    p = trees.predict(train, m, ["a", "b"])
    assert p.count() == 4 * 160
    err = p.groupBy("symbol", "model").agg(F.avg(F.abs(F.col("prediction") - F.col("target_close"))).alias("e")).collect()
    assert all(r.e < 3 for r in err)
    top = {(r.symbol, r.model): r.feature for r in trees.importances(m, ["a", "b"]).where("importance > 0.9").collect()}
    assert top == {("UP", x): "a" for x in (trees.FOREST, trees.BOOSTED)} | {("DOWN", x): "b" for x in (trees.FOREST, trees.BOOSTED)}
    again = trees.fit_symbol_trees(train.repartition(5), ["a", "b"], trees=20, rounds=40, rate=0.2)
    assert m.drop("error").exceptAll(again.drop("error")).count() == 0  # the same trees however the rows are dealt


def test_boosting_follows_its_definition(spark):
    train = rows_of(spark, ["UP"], 90)
    m = trees.fit_symbol_trees(train, ["a", "b"], trees=1, rounds=7, rate=0.3, boost_depth=2)
    rows = train.orderBy("split_rank").collect()
    x, y = np.array([[r.a, r.b] for r in rows]), np.array([r.target_close for r in rows])
    now = np.full(len(y), y.mean())
    for _ in range(7):
        left = y - now
        def walk(t, v):
            return t if isinstance(t, float) else walk(t[2] if v[t[0]] <= t[1] else t[3], v)
        t = exhaustive(x, left, np.ones(len(y)), 2)
        now = now + 0.3 * np.array([walk(t, v) for v in x])
    got = trees.predict(train, m, ["a", "b"]).where("model = 'Gradient_Boosting'").orderBy("split_rank").collect()
    assert [r.prediction for r in got] == pytest.approx(now.tolist(), abs=1e-3)


def test_bounded_fits_blocks_and_failures(spark, monkeypatch):
    train = rows_of(spark, ["UP", "BAD"], 400)
    train = train.withColumn("a", F.when((F.col("symbol") == "BAD") & (F.col("split_rank") == 7), F.lit(float("inf"))).otherwise(F.col("a")))
    m = trees.fit_symbol_trees(train, ["a", "b"], trees=4, rounds=5, fit_rows=100).cache()
    bad = m.where("error IS NOT NULL").select("symbol", "error").distinct().collect()
    full = trees.fit_symbol_trees(train, ["a", "b"], trees=4, rounds=5).where("symbol = 'BAD' AND error IS NOT NULL")
    assert full.count() == 5 and {r.symbol for r in bad} <= {"BAD"}
    assert max(len(r.feature) for r in m.where("symbol = 'UP'").collect()) <= 2 * 100
    monkeypatch.setattr(trees, "BLOCK", 50)
    cut = trees.predict(train.where("symbol = 'UP'"), m, ["a", "b"])
    monkeypatch.setattr(trees, "BLOCK", 10 ** 6)
    whole = trees.predict(train.where("symbol = 'UP'"), m, ["a", "b"])
    assert cut.count() == 800 and cut.exceptAll(whole).count() == 0
    none = trees.fit_symbol_trees(train.limit(0), ["a", "b"])
    assert none.count() == 0 and trees.predict(train, none, ["a", "b"]).count() == 0
