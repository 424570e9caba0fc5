"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with the job, so executors need no extra files
cloudpickle.register_pickle_by_value(sys.modules[__name__])
