"""Session construction and lineage cutting.

On a cluster the session already exists and carries the cluster's
settings; ``get_spark`` only fills in what is unset (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings applied only when the session does not define them already.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Spark's setting that removes the shuffle files of an execution at its end.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "barspark") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or os.environ.get("BARSPARK_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("BARSPARK_DRIVER_MEM", "16g")))
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only when the session names none (local tests) is a scratch folder
    created and registered.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="barspark-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_CLEANING = threading.Lock()
_cleaners: dict[str, list] = {}  # session settings before the first of the writes under way, and how many there are


@contextmanager
def _shuffle_cleanup(spark: SparkSession):
    """Spark's shuffle cleanup on while writes run; several threads may write at once."""
    key = spark.sparkContext.applicationId
    with _CLEANING:
        state = _cleaners.setdefault(key, [None, 0])
        if state[1] == 0:
            state[0] = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        state[1] += 1
    try:
        yield
    finally:
        with _CLEANING:
            state[1] -= 1
            if state[1] == 0:
                spark.conf.unset(SHUFFLE_CLEANUP) if state[0] is None else spark.conf.set(SHUFFLE_CLEANUP, state[0])


def stored(df: DataFrame, name: str) -> str:
    """Write ``df`` as a parquet table under the shared checkpoint folder; returns its path.

    Used at plan cut points that several branches read (instead of
    recomputing the upstream per branch); unlike an RDD checkpoint the
    result keeps parquet statistics (for AQE join choices) and column pruning.
    The write's own shuffle files are removed when it has ended: nothing
    reads them again, and a lost executor does not touch the table."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    with _shuffle_cleanup(spark):
        df.write.mode("overwrite").parquet(path)
    return path


def drop_stored(spark: SparkSession, *paths: str) -> None:
    """Remove tables written by ``stored`` that no later plan reads."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``stored`` and read back."""
    return df.sparkSession.read.parquet(stored(df, name))
