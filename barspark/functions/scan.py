"""First-order linear recurrences ``y_t = r * y_{t-1} + b_t`` as column expressions.

EMA, the RSI's smoothed gains/losses and MACD are such recurrences; no
bounded window frame expresses them.  On a blocked series (``series.blocked``):

1. ``scan_locals`` -- inside a block, ``loc_k = r^k * sum_{i<=k} b_i r^-i`` is a
   running window sum.  The block size keeps ``r^-k`` below 1e100, so the sum
   is exact to double precision.
2. ``scan_blocks`` -- every full block maps an incoming value ``c`` to
   ``r^B c + L`` (``L`` = the block's last ``loc``); the carry into block j is
   ``sum_{m>=1} rho^(m-1) L_{j-m}`` with ``rho = r^B``.  Terms with
   ``rho^(m-1) < e^-1500`` are exactly zero in double arithmetic, so the sum is
   a bounded explode + ``groupBy`` on the small block table: distributed, no
   per-key sequential pass.
3. ``scan_finish`` -- ``y = loc + r^(k+1) * carry``.

A *chained* scan (MACD's signal is the EMA of ``EMA12 - EMA26``) takes its
input from other scans' local values; ``feed`` gives the weight of each
upstream scan in its input, and the upstream carries enter through the
closed form ``G(ra, rb, k) = sum_{i<=k} ra^(i+1) rb^(k-i)``, so all levels
share one block table and one join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barspark.functions.series import block_window

_MAX_SCALE_LOG = math.log(1e100)
_ZERO_LOG = 1500.0


@dataclass(frozen=True)
class Scan:
    name: str
    b: Column                 # local input term; may use upstream ``loc(name)`` columns
    r: float                  # decay ratio, 1 - alpha
    feed: dict = field(default_factory=dict)   # upstream scan name -> weight in the input


def loc(name: str) -> Column:
    """Block-local value of scan ``name`` (valid after ``scan_locals``)."""
    return F.col(f"_loc_{name}")


def max_block(ratios: list[float], cap: int = 1024) -> int:
    """Largest power-of-two block whose ``r^-block`` stays below 1e100 for every ratio."""
    b = cap
    for r in ratios:
        if 0 < r < 1:
            lim = int(_MAX_SCALE_LOG / -math.log(r))
            while b > lim:
                b //= 2
    return max(b, 1)


def ewm_term(x: Column, alpha: float, first: Column) -> Column:
    """``b_t`` of ``ewm(alpha, adjust=False)`` seeded with the first value."""
    return F.when(first, x).otherwise(F.lit(alpha) * x)


def _check(scans: list[Scan], block: int) -> None:
    for s in scans:
        if not 0 < s.r < 1:
            raise ValueError(f"scan {s.name}: ratio must lie in (0, 1)")
        if (block - 1) * -math.log(s.r) > _MAX_SCALE_LOG + 1e-9:
            raise ValueError(f"block {block} too large for ratio {s.r}")


def _levels(scans: list[Scan]) -> list[list[Scan]]:
    done: set[str] = set()
    levels, rest = [], list(scans)
    while rest:
        lvl = [s for s in rest if all(d in done for d in s.feed)]
        if not lvl:
            raise ValueError("cyclic scan feeds")
        levels.append(lvl)
        done |= {s.name for s in lvl}
        rest = [s for s in rest if s not in lvl]
    return levels


def scan_locals(df: DataFrame, keys: list[str], scans: list[Scan], block: int) -> DataFrame:
    """Add ``_loc_<name>`` for every scan (one window pass per chaining level)."""
    _check(scans, block)
    w = block_window(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pos = F.col("_pos").cast("double")
    own = F.col("_own")
    for lvl in _levels(scans):
        df = df.withColumns({
            f"_loc_{s.name}": F.pow(F.lit(s.r), pos) * F.sum(
                F.when(own, s.b * F.pow(F.lit(s.r), -pos)).otherwise(F.lit(0.0))).over(w)
            for s in lvl})
    return df


def _geo(ra: float, rb: float, k: Column) -> Column:
    """G(ra, rb, k) = sum_{i=0..k} ra^(i+1) rb^(k-i)."""
    if abs(ra - rb) < 1e-15:
        return (k + 1) * F.pow(F.lit(ra), k + 1)
    return F.lit(ra / (rb - ra)) * (F.pow(F.lit(rb), k + 1) - F.pow(F.lit(ra), k + 1))


def scan_blocks(own: DataFrame, keys: list[str], scans: list[Scan], block: int) -> DataFrame:
    """Per (key, block) carry-in ``_C_<name>`` of every scan; ``own`` holds owned rows
    with their ``_loc_`` columns."""
    lasts = own.groupBy(*keys, "_blk").agg(
        *[F.max_by(f"_loc_{s.name}", "_idx").alias(f"_L_{s.name}") for s in scans])
    out = lasts.select(*keys, "_blk")
    carried_names: list[str] = []
    kB = F.lit(float(block - 1))
    for lvl in _levels(scans):
        src = lasts
        if carried_names:
            src = lasts.join(out, [*keys, "_blk"], "left")
        eff = {}
        for s in lvl:
            e = F.col(f"_L_{s.name}")
            for dep, wgt in s.feed.items():
                rd = next(x.r for x in scans if x.name == dep)
                e = e + F.lit(wgt) * F.coalesce(F.col(f"_C_{dep}"), F.lit(0.0)) * _geo(rd, s.r, kB)
            eff[s.name] = e
        m_max = max(int(math.ceil(_ZERO_LOG / (block * -math.log(s.r)))) + 1 for s in lvl)
        carried = (src.select(*keys, "_blk", *[v.alias(f"_E_{n}") for n, v in eff.items()])
                   .withColumn("_m", F.explode(F.sequence(F.lit(1), F.lit(m_max))))
                   .groupBy(*keys, (F.col("_blk") + F.col("_m")).alias("_blk"))
                   .agg(*[F.sum(F.col(f"_E_{s.name}") * F.pow(F.lit(s.r ** block), F.col("_m") - 1))
                          .alias(f"_C_{s.name}") for s in lvl]))
        out = out.join(carried, [*keys, "_blk"], "left")
        carried_names += [s.name for s in lvl]
    return out.fillna(0.0, subset=[f"_C_{n}" for n in carried_names])


def scan_finish(df: DataFrame, scans: list[Scan]) -> DataFrame:
    """Final scan values from local values and the joined block carries."""
    pos = F.col("_pos").cast("double")
    by_name = {s.name: s for s in scans}
    cols = {}
    for s in scans:
        y = F.col(f"_loc_{s.name}") + F.col(f"_C_{s.name}") * F.pow(F.lit(s.r), pos + 1)
        for dep, wgt in s.feed.items():
            y = y + F.lit(wgt) * F.col(f"_C_{dep}") * _geo(by_name[dep].r, s.r, pos)
        cols[s.name] = y
    return df.withColumns(cols).drop(*[f"_{p}_{s.name}" for s in scans for p in ("loc", "C")])
