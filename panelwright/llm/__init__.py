"""Operators for preparing training text: one module per operator, and the queries that apply them."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel whole, so these need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
