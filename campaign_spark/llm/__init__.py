"""Operators of a training-data pipeline. Nothing else in the package imports this one."""

import sys

from pyspark import cloudpickle

# Tasks carry these functions with them, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
