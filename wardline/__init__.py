"""wardline: clinical-style irregular time-series analytics on Spark DataFrames."""

import sys

__version__ = "0.1.0"

# Python functions that run on executors (grouped pandas functions, batch
# inference) are shipped by value, so executors need no copy of this package.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older pickler without by-value support
    pass
