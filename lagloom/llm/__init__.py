"""Operators for preparing language-model training data.

Functions of this package travel to Python workers by value, so a worker needs no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
