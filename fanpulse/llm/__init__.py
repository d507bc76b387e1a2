"""Operators of a training-data pipeline over tables of documents. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: a worker needs no copy of the repository on its path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
