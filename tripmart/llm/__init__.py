"""Operators for training-data pipelines; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel whole, so these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
