"""Physical-plan properties the design relies on."""

from barspark.operators import reports
from barspark.operators.features import features
from barspark.plans import pipeline as P
from barspark.sources.bars import bars_daily
from paths import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plan_is_jvm_only(spark):
    f = P.fact(spark, SF_SMALL)
    s = plan(features(P.bars(spark, SF_SMALL), "1d"))
    assert "BatchEvalPython" not in s and "FlatMapGroupsInPandas" not in s and "ArrowEvalPython" not in s
    assert "SinglePartition" not in s
    assert f.count() > 0


def test_top_volume_uses_window_group_limit(spark):
    f = P.fact(spark, SF_SMALL)
    s = reports.top_volume_days(f)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in s


def test_bar_scan_prunes_columns(spark):
    s = plan(bars_daily(spark, SF_SMALL))
    assert "l_comment" not in s and "l_tax" not in s and "l_discount" not in s


def test_dimension_join_is_broadcast(spark):
    f = P.fact(spark, SF_SMALL)
    df = reports.perf_summary(f, P.dim(spark, SF_SMALL))
    df.collect()
    s = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in s
