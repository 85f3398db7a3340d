"""Operators for preparing training text, and their queries."""

import sys

from pyspark import cloudpickle

# functions travel to the executors with their code, so these need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
