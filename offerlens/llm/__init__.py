"""Operators for training data, each over whole Spark tables.

Functions that run in Python workers travel with their job, so workers need not be able to
import this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
