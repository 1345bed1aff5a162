"""The topology as Structured Streaming queries.

Stateful processors reach the Python workers pickled by value, so a cluster needs no copy of the
package on its workers' path.
"""

import sys

from pyspark import cloudpickle

for _name in ("keyweave.functions", "keyweave.operators", "keyweave.streaming"):
    __import__(_name)
    cloudpickle.register_pickle_by_value(sys.modules[_name])
