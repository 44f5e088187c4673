"""Exploratory statistics (the numbers behind each reference figure), in long form.

The calendar is (all dates) x (all symbols): every symbol gets a value on
every trading date, so that grid is the output itself.  Fills run per symbol on the distributed series index.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.functions.quantiles import exact_quantiles
from barspark.functions.scalar import round_half
from barspark.functions.series import index_series
from barspark.session import materialize

CLIP = 0.1                       # returns kept strictly inside (-0.1, 0.1) for the box plot
KDE_LO, KDE_HI, KDE_STEP = -0.08, 0.08, 0.001
KDE_REACH = 9.2                  # bandwidths


def close_pivot(fact: DataFrame, symbols: list[str] | None = None) -> DataFrame:
    """date x symbol matrix of closes (the edge format of the figures).  Pass the
    symbol list to avoid Spark's extra job that discovers the pivot values."""
    g = fact.groupBy("date")
    p = g.pivot("symbol", symbols) if symbols is not None else g.pivot("symbol")
    return p.agg(F.max(round_half("close")))


def calendar_fill(fact: DataFrame) -> DataFrame:
    """Union calendar x symbols with the close forward-, then back-filled per symbol.

    Each symbol explodes the day sequence between the data's first and last
    date (two scalar subqueries); an equi-join with the distinct trading dates
    keeps the calendar.  The output is the symbols x calendar grid itself."""
    first, last = fact.select(F.min("date")).scalar(), fact.select(F.max("date")).scalar()
    dates = fact.select("date").distinct()
    grid = (fact.select("symbol").distinct()
            .select("symbol", F.explode(F.sequence(first, last)).alias("date"))
            .join(dates, "date"))
    cal = grid.join(fact.select("symbol", "date", "close"), ["symbol", "date"], "left")
    filled = index_series(cal, ["symbol"], "date", F.year("date"), dedup=False, fill=["close"])
    return filled.select("symbol", "date", "close", "_idx")


def rebased_growth(fact: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Filled close divided by the symbol's first filled close, times 100 (``calendar``: a stored ``calendar_fill``)."""
    c = calendar if calendar is not None else materialize(calendar_fill(fact), "calendar")
    first = c.filter(F.col("_idx") == 0).select("symbol", F.col("close").alias("_c0"))
    return (c.join(first, "symbol")
            .select("symbol", "date", round_half(F.try_divide(F.col("close"), F.col("_c0")) * 100)
                    .alias("rebased_close")))


def price_corr(fact: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """Pearson correlation of filled closes (price levels) for every symbol pair.

    Pairs are formed per date on the upper triangle only and mirrored; the
    pair set is the output itself (a symbols x symbols matrix)."""
    c = calendar if calendar is not None else materialize(calendar_fill(fact), "calendar")
    c = c.select("symbol", "date", "close")
    a = c.select(F.col("symbol").alias("symbol_a"), "date", F.col("close").alias("x"))
    b = c.select(F.col("symbol").alias("symbol_b"), "date", F.col("close").alias("y"))
    up = (a.join(b, "date").filter(F.col("symbol_a") <= F.col("symbol_b"))
          .groupBy("symbol_a", "symbol_b").agg(F.corr("x", "y").alias("corr")))
    # mirror the upper triangle without recomputing it
    pair = F.array(F.struct(F.col("symbol_a").alias("a"), F.col("symbol_b").alias("b")),
                   F.struct(F.col("symbol_b").alias("a"), F.col("symbol_a").alias("b")))
    both = up.select(F.explode(F.array_distinct(pair)).alias("p"), "corr")
    return both.select(F.col("p.a").alias("symbol_a"), F.col("p.b").alias("symbol_b"),
                       round_half("corr").alias("corr"))


def clipped_returns(fact: DataFrame, clip: float = CLIP) -> DataFrame:
    """Bars whose daily return lies strictly inside (-clip, clip)."""
    return (fact.filter((F.col("daily_return") > -clip) & (F.col("daily_return") < clip))
            .select("symbol", "date", round_half("daily_return", 6).alias("daily_return")))


def return_box(fact: DataFrame, clip: float = CLIP) -> DataFrame:
    """Tukey box per symbol over the clipped returns: quartiles, whiskers = the most
    extreme returns inside Q1/Q3 -/+ 1.5 IQR, count outside."""
    r = fact.filter((F.col("daily_return") > -clip) & (F.col("daily_return") < clip))
    q = exact_quantiles(r, ["symbol"], "daily_return", [0.25, 0.5, 0.75])
    n = r.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    fences = q.join(n, "symbol").select("symbol", "n", F.col("daily_return_q0").alias("q1"),
                                        F.col("daily_return_q1").alias("median"),
                                        F.col("daily_return_q2").alias("q3"))
    fences = fences.withColumns({"_lo": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                                 "_hi": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    x = F.col("daily_return")
    inside = (x >= F.col("_lo")) & (x <= F.col("_hi"))
    w = r.join(fences, "symbol").groupBy("symbol", "n", "q1", "median", "q3").agg(
        F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))
    return w.select("symbol", "n", *[round_half(c, 6).alias(c) for c in
                                     ("q1", "median", "q3", "whisker_low", "whisker_high")], "outliers")


def avg_volume_millions(fact: DataFrame) -> DataFrame:
    return fact.groupBy("symbol").agg(round_half(F.avg("volume") / 1e6, 6).alias("volume_millions"))


def return_kde(fact: DataFrame, lo: float = KDE_LO, hi: float = KDE_HI, step: float = KDE_STEP) -> DataFrame:
    """Gaussian kernel density of daily returns per symbol on a fixed grid.

    Bandwidth by Scott's rule, ``h = s * n^(-1/5)`` with the sample std of all
    the symbol's returns; the grid (161 points by default) only limits the
    display range.  A return is carried to the grid points within ``KDE_REACH`` bandwidths only
    (beyond them a kernel is below 1e-18 of its height); points that no return reaches have density 0."""
    npts = int(round((hi - lo) / step)) + 1
    stats = fact.groupBy("symbol").agg(F.count("daily_return").alias("_n"),
                                       F.stddev_samp("daily_return").alias("_s"))
    bw = stats.select("symbol", "_n", (F.col("_s") * F.pow(F.col("_n").cast("double"), -0.2)).alias("_h")).filter("_n > 0")
    at = lambda i: F.lit(lo) + i * F.lit(step)
    pts = fact.select("symbol", "daily_return").filter(F.col("daily_return").isNotNull()).join(bw.select("symbol", "_h"), "symbol")
    reach, place = KDE_REACH * F.col("_h"), lambda v: (v - lo) / step
    pts = pts.withColumns({
        "_from": F.ceil(F.least(F.greatest(place(F.col("daily_return") - reach), F.lit(0.0)), F.lit(float(npts)))).cast("int"),
        "_to": F.floor(F.greatest(F.least(place(F.col("daily_return") + reach), F.lit(npts - 1.0)), F.lit(-1.0))).cast("int")})
    pts = pts.filter("_h > 0 AND _from <= _to").select("symbol", "daily_return", "_h", F.explode(F.sequence("_from", "_to")).alias("_i"))
    u = (at(F.col("_i")) - F.col("daily_return")) / F.col("_h")
    dens = pts.groupBy("symbol", "_i").agg(F.sum(F.exp(-0.5 * u * u)).alias("_k"))
    grid = bw.select("symbol", "_n", "_h", F.explode(F.sequence(F.lit(0), F.lit(npts - 1))).alias("_i")).join(dens, ["symbol", "_i"], "left")
    norm = F.col("_n") * F.col("_h") * F.lit(math.sqrt(2 * math.pi))
    return grid.select("symbol", F.round(at(F.col("_i")), 6).alias("x"),
                       round_half(F.try_divide(F.coalesce("_k", F.lit(0.0)), norm), 6).alias("density"))
