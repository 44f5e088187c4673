"""Operations of a training-data pipeline: URL lists, extraction, scoring, dedup, mixing, tokenizing.

Nothing else in the package imports this subpackage; ``barspark.llm.queries``
holds the registered queries and their SQL twins.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel whole: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
