"""Whitening: bit-sliced products and moments against whole-number sums, components against a plain eigendecomposition."""

import math
from fractions import Fraction

import numpy as np
import pytest

from barspark.llm import whitening


def vectors(n=300, d=12, seed=3):
    r = np.random.default_rng(seed)
    mix = r.normal(size=(d, d))
    return (r.normal(size=(n, d)) @ mix + r.normal(size=d) * 5).astype(np.float32)


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, id string, n int")


@pytest.mark.parametrize("n,d,high", [(1, 3, 5), (64, 4, 1), (65, 5, 1000), (200, 3, 1 << 50), (100, 2, 1)])
def test_products_are_exact(n, d, high):
    z = np.random.default_rng(n).integers(-high, high + 1, (n, d))
    want = [[sum(int(x) * int(y) for x, y in zip(z[:, a], z[:, b])) for b in range(d)] for a in range(d)]
    assert whitening.products(z).tolist() == want


def test_whitening_equals_exact_moments(spark, monkeypatch):
    v = vectors()
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    bad = [(900, None), (901, [None] + [1.0] * 11), (902, [math.nan] * 12), (903, [math.inf] + [0.0] * 11), (904, []), (905, [1.0] * 5)]
    same = [(None, rows[0][1]), (0, rows[0][1])]
    got = whitening.whiten(table(spark, rows + bad + same), most=5).collect()
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in r] for _, r in rows + same], object)
    n, total = len(x), x.sum(0)
    assert len(got) == 5 * n and {r.n for r in got} == {n}
    cov = np.array([[float(Fraction(int(n * (x[:, a] * x[:, b]).sum() - total[a] * total[b]), n * n)) for b in range(12)] for a in range(12)])
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    out = {}
    for r in got:
        out.setdefault(r.vec_id, []).append(r)
    for k, (i, _) in enumerate(rows[:40]):
        mine = sorted(out[i], key=lambda r: r.component)[:: 2 if i == 0 else 1]
        assert mine[0].deviation == sum((n * int(c) - int(s)) ** 2 for c, s in zip(x[k], total))
        for j, r in enumerate(mine):
            want = float((x[k] - np.array([Fraction(int(s), n) for s in total])).astype(float) @ u[:, j]) / math.sqrt(e[j])
            assert abs(abs(r.whitened) - abs(want)) < 1e-9
            assert r.explained == pytest.approx(e[j] / np.trace(cov), rel=1e-9) and r.identity_error < 1e-9
    w = np.array([[r.whitened for r in sorted(rs, key=lambda r: r.component)] for i, rs in out.items() if len(rs) == 5])
    assert out[None][0].n == n and len(out[0]) == 10 and len(w) == n - 2
    both = np.concatenate([w, *[[[r.whitened for r in sorted(out[0], key=lambda r: r.component)][::2]]] * 2])
    assert np.abs(both.T @ both / n - np.eye(5)).max() < 1e-9  # measured on the rows, not taken from the column


def test_blocks_and_tasks_change_nothing(spark, monkeypatch):
    rows = [(i, x.tolist()) for i, x in enumerate(vectors(200, 6))]
    df = table(spark, rows)
    good, d = whitening.usable(df.repartition(1), "vec_id", "embedding")
    one = whitening.moments(good, d)
    many = whitening.moments(whitening.usable(df.repartition(7), "vec_id", "embedding")[0], d)
    assert one[0] == many[0] and one[1] == many[1] and (one[2] == many[2]).all()
    parts = list(whitening._scatter(6)(iter(good.select("v").toArrow().to_batches())))
    monkeypatch.setattr(whitening, "BLOCK", 60)
    cut = list(whitening._scatter(6)(iter(good.select("v").toArrow().to_batches(max_chunksize=7))))
    assert parts[0].equals(cut[0])


def test_no_variance_far_entries_and_empty_tables(spark):
    flat = whitening.whiten(table(spark, [(1, [2.0, 3.0]), (2, [2.0, 3.0])])).collect()
    assert len(flat) == 4 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in flat)
    one = whitening.whiten(table(spark, [(1, [0.0, 3.0]), (2, [1.0, 3.0])])).collect()
    assert sorted((r.component, r.whitened is None) for r in one) == [(1, False), (1, False), (2, True), (2, True)]
    assert {round(abs(r.whitened), 9) for r in one if r.whitened is not None} == {1.0}
    far = whitening.whiten(table(spark, [(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [5.0, 2.0])])).collect()
    assert all(r.deviation is None for r in far if r.vec_id != 3) and all(math.isfinite(r.whitened) for r in far if r.whitened is not None)
    assert whitening.whiten(table(spark, [])).count() == 0 and whitening.whiten(table(spark, [(1, None)])).count() == 0
    with pytest.raises(ValueError):
        whitening.usable(table(spark, [(1, [0.0] * (whitening.MOST_DIMENSIONS + 1))]), "vec_id", "embedding")
