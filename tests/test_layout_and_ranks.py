"""Newest-first files, ranks over ranges, the banded density and the measures of a suite's reports."""

import math

from pyspark.sql import functions as F

from barspark.functions.ranking import positions, ranks
from barspark.operators import dashboard, eda
from barspark.plans import pipeline as P
from barspark.plans.suite import observed, run_suite
from paths import SF_SMALL


def scans(df):
    """(rows read, plan text) of the only scan of a plan without shuffles."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().get("numOutputRows").get().value(), df._jdf.queryExecution().executedPlan().toString()


def test_last_bars_leave_older_row_groups_unread(spark, tmp_path):
    f = P.fact(spark, SF_SMALL)
    path = str(tmp_path / "fact")
    (f.repartition(2).sortWithinPartitions("from_end").write.option("parquet.block.size", 16384)
     .option("parquet.block.size.row.check.min", 10).option("parquet.page.size.row.check.min", 10)
     .option("parquet.page.row.count.limit", 100).option("parquet.page.size", 1024).parquet(path))
    stored = spark.read.parquet(path)
    read, plan = scans(dashboard.latest(stored).select("symbol", "close"))
    assert "PushedFilters: [IsNotNull(from_end), LessThan(from_end,1)]" in plan
    total = stored.count()
    symbols = stored.select("symbol").distinct().count()
    assert symbols <= read < total / 4


def test_fact_files_hold_the_newest_bars_first(spark):
    f = P.fact(spark, SF_SMALL).select("from_end", F.spark_partition_id().alias("p"), "_metadata.file_path", F.monotonically_increasing_id().alias("i"))
    files = {}
    for r in f.collect():
        files.setdefault(r.file_path, []).append((r.i, r.from_end))
    assert all(x == sorted(x) and [e for _, e in x] == sorted(e for _, e in x) for x in files.values())
    plain = P.fact(spark, SF_SMALL).drop("from_end")
    want = {tuple(r) for r in dashboard.latest_kpis(plain).collect()}
    assert {tuple(r) for r in dashboard.latest_kpis(P.fact(spark, SF_SMALL)).collect()} == want


def test_positions_spread_values_of_one_unit(spark):
    df = spark.range(4000).select(((F.col("id") * 7919 % 4000) / 4000.0).alias("x"), F.col("id"))
    at = positions(df, F.col("x").desc(), "pos", partitions=8).cache()
    assert at.select("_part").distinct().count() >= 6
    assert [r.pos for r in at.orderBy(F.col("x").desc()).collect()] == list(range(4000))


def test_ranks_of_ties_and_nulls(spark):
    rows = [(i, v) for i, v in enumerate([3.0, None, 5.0, 3.0, 5.0, 1.0, None, 3.0])]
    df = spark.createDataFrame(rows, "id int, v double")
    got = {r.id: r["rank"] for r in ranks(df, F.col("v").desc_nulls_last(), ["v"], "rank", partitions=3).collect()}
    assert got == {2: 1, 4: 1, 0: 3, 3: 3, 7: 3, 5: 6, 1: 7, 6: 7}
    assert ranks(df.limit(0), F.col("v").desc_nulls_last(), ["v"], "rank").count() == 0


def test_density_against_brute_force(spark):
    data = {"A": [0.001 * (i % 23 - 11) for i in range(300)], "B": [0.01, 0.01, 0.01], "C": [0.02],
            "D": [-0.5, 0.5, 0.0, 0.004], "E": [5.0, 5.001, 5.002]}
    rows = [(s, x) for s, xs in data.items() for x in xs] + [("A", None), ("F", None)]
    got = {}
    for r in eda.return_kde(spark.createDataFrame(rows, "symbol string, daily_return double")).collect():
        got.setdefault(r.symbol, {})[round(r.x, 6)] = r.density
    assert set(got) == set(data) and all(len(v) == 161 for v in got.values())
    for s, xs in data.items():
        n, mean = len(xs), sum(xs) / len(xs)
        h = math.sqrt(sum((x - mean) ** 2 for x in xs) / (n - 1)) * n ** -0.2 if n > 1 else None
        for x, d in got[s].items():
            if not h or h < 1e-12:
                assert d is None or s == "B"
            else:
                want = sum(math.exp(-0.5 * ((x - v) / h) ** 2) for v in xs) / (n * h * math.sqrt(2 * math.pi))
                assert abs(d - want) <= 1.01e-6 * max(1, want), (s, x)


def test_suite_measures_and_isolation(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, None)], "x int, `y.z` string")
    m = observed(df)
    assert (m["n_rows"], m["n_nulls"]) == (3, 3)
    assert observed(df.orderBy(F.desc("x")))["value_hash"] == m["value_hash"]
    got = {r.query_name: r for r in run_suite(spark, SF_SMALL, ["perf_summary", "no_such_report", "close_pivot"]).collect()}
    assert got["no_such_report"].status == "failed" and got["no_such_report"].n_rows is None
    assert got["perf_summary"].n_rows > 0 and got["close_pivot"].status == "ok"
