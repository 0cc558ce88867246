"""Commerce analytics jobs expressed with Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions handed to mapInPandas / applyInPandas travel by value, so executors do not need this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
