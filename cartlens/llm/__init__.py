"""Operators for preparing training data: one module per operator, queries in queries.py."""

import sys

from pyspark import cloudpickle

# Python workers get these functions with the task, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
