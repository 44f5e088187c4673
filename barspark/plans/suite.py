"""Run a list of registered reports with fault isolation: name, status, rows, and what their values look like."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "query_name string, status string, n_rows long, n_nulls long, value_hash long, error string"


def observed(df: DataFrame) -> dict:
    """Runs a report once, whole, and takes its measures on the way: rows, null cells, a hash of all values in any order."""
    seen = Observation()
    cells = reduce(lambda a, b: a + b, [F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns])
    df.observe(seen, F.count(F.lit(1)).alias("n_rows"), cells.alias("n_nulls"),
               F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).alias("value_hash")).write.format("noop").mode("overwrite").save()
    return seen.get


def run_suite(spark: SparkSession, sf_dir: str, names: list[str], at_once: int = 4) -> DataFrame:
    """One failing report does not stop the others (the reference's behaviour).

    Each report runs as its own Spark job, ``at_once`` of them side by side, so that the
    cores that one report's last tasks leave idle serve the next; only measures return.  The tables that reports
    share are stored first, each once."""
    from barspark.plans import pipeline as P
    from barspark.plans.registry import REGISTRY
    P.fact(spark, sf_dir)
    P.calendar(spark, sf_dir)

    def run(name: str) -> tuple:
        try:
            m = observed(REGISTRY[name][0](spark, sf_dir))
            return name, "ok", m["n_rows"], m["n_nulls"], m["value_hash"], None
        except Exception as e:  # recorded, not raised
            return name, "failed", None, None, None, str(e)
    with ThreadPoolExecutor(at_once) as pool:
        rows = list(pool.map(run, names))
    return spark.createDataFrame(rows, SCHEMA)
