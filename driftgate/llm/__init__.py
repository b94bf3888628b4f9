"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# The functions of this package travel with the tasks that call them, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
