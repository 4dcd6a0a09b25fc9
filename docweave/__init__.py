"""docweave: a Spark-native pipeline that turns documents into chunks,
enriches them with model output, batches embedding requests and tracks
every document to completion.

Every operator takes and returns DataFrames; nothing is collected to the
driver except size-bounded planning values (range bounds, one scalar).
"""

import sys as _sys

__version__ = "0.1.0"

# Python code that runs in Spark's Python workers (the NFC Arrow UDF, the
# recursive splitter in mapInArrow) is pickled by value, so executors do
# not need this package installed or on their path.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older pyspark: ship the package with --py-files instead
    pass
