"""barspark: Spark-native analytics over OHLCV price bars.

Every operator is a ``DataFrame -> DataFrame`` function meant for
``df.transform``; nothing collects to the driver.  See README.md.
"""

from barspark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]

# Python functions shipped to executors (grouped-map and state functions) are
# pickled by value, so executors need no installed copy of the package.
try:  # pragma: no cover - depends on the pyspark build
    import sys as _sys

    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001
    pass
