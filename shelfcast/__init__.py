"""Retail demand and inventory analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value: workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
