"""Portfolio risk over a weights table (portfolio_id, symbol, weight_pct).

Many portfolios score in one job.  Dates are aligned per portfolio by
keeping the dates on which every member has a bar (the reference's chain of
inner merges, generalised to N assets); returns are taken between
consecutive common dates.  Annualisation uses 252 trading days and the
Sharpe ratio a 4% risk-free rate.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barspark.functions.scalar import round_half

# Annualisation days, risk-free rate and Sharpe labels of the reference.
TRADING_DAYS = 252
RISK_FREE = 0.04
SHARPE_LABELS = ("Premium Returns", "Moderate Returns")


def region_portfolios(spark, sf_dir: str) -> DataFrame:
    """Weights derived from the driver tables: one portfolio per region holding its
    nations, integer percents split evenly (remainder to the first members)."""
    from barspark.sources.tables import table
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    m = n.join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    w = Window.partitionBy("r_name").orderBy("n_nationkey")
    k = F.count(F.lit(1)).over(Window.partitionBy("r_name"))
    rank = F.row_number().over(w)
    base = F.floor(F.lit(100) / k)
    pct = base + F.when(rank <= F.lit(100) - base * k, F.lit(1)).otherwise(F.lit(0))
    return m.select(F.col("r_name").alias("portfolio_id"), F.col("n_name").alias("symbol"),
                    pct.cast("int").alias("weight_pct"))


def validate_weights(weights: DataFrame) -> DataFrame:
    """Total weight per portfolio; valid only at exactly 100%."""
    return weights.groupBy("portfolio_id").agg(
        F.sum("weight_pct").alias("total_weight_pct"), F.count(F.lit(1)).alias("n_assets")
    ).withColumn("is_valid", F.col("total_weight_pct") == 100)


def valid_portfolios(weights: DataFrame) -> DataFrame:
    """Weights of the portfolios that total exactly 100%; the others are not scored."""
    good = validate_weights(weights).filter("is_valid").select("portfolio_id")
    return weights.join(good, "portfolio_id", "left_semi")


def aligned_returns(fact: DataFrame, weights: DataFrame) -> DataFrame:
    """(portfolio_id, symbol, date, weight, ret): returns between consecutive dates
    common to all members; the first common date has no return and is dropped."""
    k = weights.groupBy("portfolio_id").agg(F.count(F.lit(1)).alias("_k"))
    px = fact.select("symbol", "date", "close").join(weights, "symbol")
    common = (px.groupBy("portfolio_id", "date").agg(F.count(F.lit(1)).alias("_c"))
              .join(k, "portfolio_id").filter(F.col("_c") == F.col("_k")).select("portfolio_id", "date"))
    al = px.join(common, ["portfolio_id", "date"])
    w = Window.partitionBy("portfolio_id", "symbol").orderBy("date")
    ret = F.try_divide(F.col("close"), F.lag("close").over(w)) - 1
    return (al.withColumn("ret", ret).filter(F.col("ret").isNotNull())
            .select("portfolio_id", "symbol", "date", (F.col("weight_pct") / 100.0).alias("weight"), "ret"))


def portfolio_cov(rets: DataFrame) -> DataFrame:
    """Annualised sample covariance for every member pair of each portfolio
    (pairs of a portfolio's own members only)."""
    a = rets.select("portfolio_id", "date", F.col("symbol").alias("symbol_a"), F.col("ret").alias("ra"))
    b = rets.select("portfolio_id", "date", F.col("symbol").alias("symbol_b"), F.col("ret").alias("rb"))
    return (a.join(b, ["portfolio_id", "date"]).groupBy("portfolio_id", "symbol_a", "symbol_b")
            .agg(round_half(F.covar_samp("ra", "rb") * TRADING_DAYS, 6).alias("annual_cov")))


def portfolio_risk(rets: DataFrame) -> DataFrame:
    """Expected annual return sum(w * mean(r)) * 252, volatility = annualised sample
    std of the daily portfolio return sum(w * r) (equal to sqrt(w' Cov w)),
    Sharpe = (return - rf) / volatility (null when volatility is 0)."""
    mean_r = rets.groupBy("portfolio_id", "symbol", "weight").agg(F.avg("ret").alias("_m"))
    exp_r = mean_r.groupBy("portfolio_id").agg((F.sum(F.col("weight") * F.col("_m")) * TRADING_DAYS).alias("_er"))
    daily = rets.groupBy("portfolio_id", "date").agg(F.sum(F.col("weight") * F.col("ret")).alias("_pr"))
    vol = daily.groupBy("portfolio_id").agg((F.stddev_samp("_pr") * math.sqrt(TRADING_DAYS)).alias("_v"))
    sharpe = F.try_divide(F.col("_er") - RISK_FREE, F.when(F.col("_v") != 0, F.col("_v")))
    return exp_r.join(vol, "portfolio_id").select(
        "portfolio_id", round_half("_er", 6).alias("expected_annual_return"),
        round_half("_v", 6).alias("annual_volatility"), round_half(sharpe, 6).alias("sharpe_ratio"),
        F.when(sharpe > 1, F.lit(SHARPE_LABELS[0])).otherwise(F.lit(SHARPE_LABELS[1])).alias("sharpe_label"))


def portfolio_growth(rets: DataFrame) -> DataFrame:
    """Cumulative growth of 1 invested: running product of (1 + sum(w * r)) per
    portfolio, as exp of a running sum of logs (our definition of the README's
    'portfolio performance tracking').  One row per portfolio-date: the window
    per portfolio is bounded by the number of common dates."""
    daily = rets.groupBy("portfolio_id", "date").agg(F.sum(F.col("weight") * F.col("ret")).alias("_pr"))
    w = Window.partitionBy("portfolio_id").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    lg = F.sum(F.ln(1 + F.col("_pr"))).over(w)
    # growth spans many orders of magnitude: the log is reported to fixed
    # decimals, the level in scientific notation (7 significant digits)
    return (daily.withColumn("_lg", lg)
            .select("portfolio_id", "date", round_half("_pr", 6).alias("portfolio_return"),
                    round_half("_lg", 6).alias("log_growth"),
                    F.format_string("%.6e", F.exp(round_half("_lg", 9))).alias("growth")))
