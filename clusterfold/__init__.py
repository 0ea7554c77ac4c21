"""clusterfold: data preparation, K-means and gradient-descent regression
as PySpark DataFrame jobs."""

import sys as _sys

__version__ = "0.1.0"

# Functions of this package that run inside Python workers (mapInPandas,
# applyInPandas) are shipped by value, so executors need no installed copy.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass
