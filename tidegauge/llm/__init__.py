"""Operators for preparing training text, on tables of documents and conversations.

Functions of this package that run in Python workers are pickled by value, so
executors need Spark and the third-party libraries but no copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
