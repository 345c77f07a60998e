"""Operators for training-data pipelines.

Functions of this package that run in Python workers travel by value, so executors
need the third-party libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
