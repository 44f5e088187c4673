"""Benchmark: the ETL and every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line.  Protocol: a warm-up query starts the JVM; the ETL
(bars -> features, materialized like the reference's fact table) is timed
once per grain, the shared forecaster fit once; then each query is run once as warm-up and
``$BENCH_REPEAT`` (default 1) more times into the ``noop`` sink, and the
median is reported.  ``value`` is the sum of the ETL and query times; the
forecaster fit (ML training, shared by the forecasting queries) is reported
as ``model_fit_sec`` and included in ``total_sec``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barspark.session import get_spark  # noqa: E402

SKIP = set(filter(None, os.environ.get("BENCH_SKIP", "").split(",")))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=cpus)
    spark.range(1000).selectExpr("sum(id)").collect()

    from barspark.plans import pipeline as P
    from barspark.plans.registry import REGISTRY

    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for grain in ("1d", "1h"):
        t = time.perf_counter()
        P.bars(spark, sf_dir, grain)
        times[f"etl_bars_{grain}"] = round(time.perf_counter() - t, 3)
        t = time.perf_counter()
        P.fact(spark, sf_dir, grain)
        times[f"etl_features_{grain}"] = round(time.perf_counter() - t, 3)
    if "forecast_metrics" not in SKIP:
        # model fits are shared by the forecasting queries: time them once here
        from barspark.plans.registry import _metrics
        t = time.perf_counter()
        _metrics(spark, sf_dir)
        times["etl_forecasters_1d"] = round(time.perf_counter() - t, 3)

    failed = {}
    for name, (fn, _) in REGISTRY.items():
        if name in SKIP:
            continue
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
            runs = []
            for _ in range(max(repeat, 1)):
                t = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t)
            times[name] = round(statistics.median(runs), 3)
        except Exception as e:  # keep benchmarking the rest
            failed[name] = str(e)
    fit = times.get("etl_forecasters_1d", 0.0)
    analytics = round(sum(times.values()) - fit, 3)
    out = {"metric": "etl_fit_and_query_seconds", "value": round(analytics + fit, 3), "unit": "sec",
           "without_fit_sec": analytics, "model_fit_sec": fit,
           "queries": times, "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
