"""Feature, lag-matching and evaluation operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# functions travel to Python workers by value, so a worker needs no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
