"""Operators for training-data pipelines over documents, pages, vectors and conversations."""

import sys

from pyspark import cloudpickle

# The executors get these functions by value, they need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
