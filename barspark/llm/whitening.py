"""Embedding whitening by a bit-sliced scatter matrix.

Entries become whole numbers.  A task takes a block of rows, shifts every
dimension by its smallest number in the block, and packs bit ``i`` of a
dimension over all rows of the block into 64-bit words (a bit plane).  The
sum of products of two dimensions is then the sum over their planes of
``2**(i + j)`` times the bits that are set in both, counted by AND and
popcount; the shifts are put back in whole numbers.  Spark adds up the blocks;
``n * sum(xy) - sum(x) * sum(y)`` is formed in whole numbers too, so the
covariance is exact up to its one rounding to double before ``eigh``.

What the driver and the tasks hold beside the rows is one matrix of the
dimensions (refused above ``MOST_DIMENSIONS``), whatever the number of rows.

Edge cases: rows whose vector is null or holds null or non-finite entries
are dropped, as are vectors of another length than the most common one (the
longer one on a tie); entries beyond +-2**44 count as that bound.  Equal
rows and null ids stay and count each.  Components of no variance (fewer
rows than dimensions, constant dimensions) are listed with a null
``whitened``; if nothing varies ``explained`` and ``identity_error`` are
null.  ``deviation`` is null where it does not fit 64 bits.  An empty table
gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
MOST_DIMENSIONS = 2048
#: Numbers of a block, and the largest entry.
BLOCK, LARGEST = 4_000_000, float(1 << 44)


def numbers(vectors: pa.Array, d: int) -> np.ndarray:
    """Rows of ``floor(64 c)``; the constant added to them in the contract changes no covariance and no deviation."""
    c = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    return np.floor(SCALE * np.clip(c, -LARGEST, LARGEST)).astype(np.int64)


def bit_planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Planes of non-negative numbers (rows x dimensions): words, and the dimension and the bit of every plane."""
    bits = [int(m).bit_length() for m in y.max(0)]
    dim = np.repeat(np.arange(y.shape[1]), bits)
    bit = np.concatenate([np.arange(b) for b in bits]) if len(dim) else np.empty(0, np.int64)
    words = np.zeros((len(dim), -(-len(y) // 64) * 8), np.uint8)
    for k in range(max(bits, default=0)):
        of = np.flatnonzero(bit == k)
        packed = np.packbits(((y[:, dim[of]] >> k) & 1).astype(np.uint8), axis=0)
        words[of, :packed.shape[0]] = packed.T
    return words.view(np.uint64), dim, bit


def products(z: np.ndarray) -> np.ndarray:
    """Sums of products of all pairs of columns, exact (Python integers), by AND and popcount over bit planes."""
    n, d = z.shape
    low = z.min(0)
    y = z - low
    planes, dim, bit = bit_planes(y)
    both = np.zeros((len(dim), len(dim)), np.int64)
    for i in range(len(dim)):
        both[i, i:] = np.bitwise_count(planes[i] & planes[i:]).sum(1, dtype=np.int64)
    both = np.triu(both) + np.triu(both, 1).T
    small = 2 * int(bit.max(initial=0)) + 2 + n.bit_length() < 63
    weigh = np.zeros((d, len(dim)), np.int64 if small else object)
    weigh[dim, np.arange(len(dim))] = (np.int64(1) << bit) if small else [1 << int(b) for b in bit]
    inner = (weigh @ both.astype(weigh.dtype) @ weigh.T).astype(object)
    sums, low = y.sum(0).astype(object), low.astype(object)
    return inner + np.outer(low, sums) + np.outer(sums, low) + n * np.outer(low, low)


def _scatter(d: int):
    """Batches of vectors -> one row per pair of dimensions and task: a, b, sum of products (b = -1: the sum of a; a = -1: rows)."""
    at = [(a, b) for a in range(d) for b in range(a, d)]

    def run(it):
        n, sums, cross = 0, np.zeros(d, object), np.zeros((d, d), object)
        held, rows = [], 0

        def add():
            nonlocal n, sums, cross
            z = np.concatenate(held)
            n, sums, cross = n + len(z), sums + z.sum(0).astype(object), cross + products(z)
            held.clear()

        for batch in it:
            held.append(numbers(batch.column(0), d))
            rows += batch.num_rows
            if rows * d >= BLOCK:
                add()
                rows = 0
        if rows:
            add()
        if n:
            keys = [(-1, -1), *[(a, -1) for a in range(d)], *at]
            values = [n, *sums, *[cross[a, b] for a, b in at]]
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                                              pa.array([int(v) for v in values], pa.decimal128(38, 0))], ["a", "b", "v"])
    return run


def usable(df: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """Rows that take part (id, v) and their dimension, 0 if there are none."""
    v = F.col("v")
    off = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    good = df.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v")).where(v.isNotNull() & ~F.coalesce(F.exists(v, off), F.lit(False)))
    sizes = good.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).where("d > 0")
    most = sizes.orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    d = most[0]["d"] if most else 0
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} entries; the covariance is formed for {MOST_DIMENSIONS} at most")
    return good.where(F.size("v") == d), d


def moments(good: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """Rows, sums and the centred scatter ``n * sum(xy) - sum(x) * sum(y)``, all in whole numbers."""
    part = good.select("v").mapInArrow(_scatter(d), "a int, b int, v decimal(38,0)")
    rows = part.groupBy("a", "b").agg(F.sum("v").alias("v")).collect()  # d * (d + 3) / 2 + 1 rows
    got = {(r["a"], r["b"]): int(r["v"]) for r in rows}
    n, sums = got[-1, -1], [got[a, -1] for a in range(d)]
    centred = np.zeros((d, d), object)
    for a in range(d):
        for b in range(a, d):
            centred[a, b] = centred[b, a] = n * got[a, b] - sums[a] * sums[b]
    return n, sums, centred


def components(n: int, centred: np.ndarray, most: int) -> dict:
    """Unit eigenvectors of the covariance by falling eigenvalue, and what is said of each."""
    d = len(centred)
    v = np.array([[c / (n * n) for c in row] for row in centred], np.float64)  # one correct rounding each
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:most], u[:, ::-1][:, :most]
    u = u * np.where(u[np.abs(u).argmax(0), np.arange(u.shape[1])] < 0, -1.0, 1.0)
    trace = float(np.trace(v))
    real = e > max(float(e[0]), 0.0) * d * np.finfo(float).eps if trace > 0 else np.zeros(len(e), bool)
    scaled = u / np.sqrt(np.where(real, e, 1.0))
    error = np.abs(scaled[:, real].T @ v @ scaled[:, real] - np.eye(int(real.sum()))).max() if real.any() else None
    return {"scaled": scaled, "real": real, "explained": e / trace if trace > 0 else None, "identity_error": error}


def _project(d: int, n: int, sums: list[int], c: dict):
    k = len(c["real"])
    total = np.array(sums, object)

    def run(it):
        for batch in it:
            z = numbers(batch.column("v"), d)
            m = len(z)
            if max([n * int(np.abs(z).max(initial=0)), *map(abs, sums)]) < 1 << 61:
                far = n * z - total.astype(np.int64)
            else:
                far = n * z.astype(object) - total
            if d * int(np.abs(far).max(initial=0)) ** 2 < 1 << 63:
                square = far.astype(np.int64)
                dev = pa.array((square * square).sum(1), pa.int64())
            else:
                dev = pa.array([s if s < 1 << 63 else None for s in (far.astype(object) ** 2).sum(1)], pa.int64())
            out = (far.astype(np.float64) / n) @ c["scaled"]
            each = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, n)), dev.take(each),
                pa.array(out.ravel(), mask=np.tile(~c["real"], m)),
                pa.array(np.tile(c["explained"], m)) if c["explained"] is not None else pa.nulls(m * k, pa.float64()),
                pa.array([c["identity_error"]] * (m * k), pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = 32) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``identity_error`` is the largest absolute entry of the whitened
    columns' covariance minus the identity, formed from the exact covariance.
    """
    id_type = df.select(id_col).schema[0].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    good, d = usable(df, id_col, vector_col)
    if not d:
        return df.sparkSession.createDataFrame([], schema)
    n, sums, centred = moments(good, d)
    return good.mapInArrow(_project(d, n, sums, components(n, centred, min(most, d))), schema)
