"""Operators for preparing training data, each a function from DataFrames to DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in tasks travel with the plan, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
