"""Operators of a large training-data pipeline. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with their helpers, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
