"""meridian: a Spark-native engine for landing, conforming and testing open data.

Everything here takes and returns DataFrames; the work runs on Spark executors.
"""

import sys as _sys

__version__ = "0.1.0"

# Python functions handed to executors (the spreadsheet reader's mapInPandas, fixture
# builders' applyInPandas) are shipped by value, so workers do not need this package
# on their import path (cluster executors, or a driver started from another folder).
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: ship the package with addPyFile instead
    pass
