"""tidemark: layered data-pipeline operators written as plain PySpark."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# helpers used inside tasks travel with the task, so executors need no copy of this package
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
