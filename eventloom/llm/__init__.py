"""Operators for preparing training data; nothing else in the library uses them."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so that executors
# need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
