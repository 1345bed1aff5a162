"""Operators of a training-data pipeline, on Spark DataFrames.

Nothing else in the library imports this package. Functions that run inside Python
workers are pickled by value, so a cluster needs no copy of the package on its
workers' path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
