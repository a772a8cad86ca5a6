"""Operators for training-data pipelines. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Python workers need only what Spark ships to them: functions of this package travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
