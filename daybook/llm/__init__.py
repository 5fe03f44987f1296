"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel by value, so that executors need not have
# this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
