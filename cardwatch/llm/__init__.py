"""Operators for preparing training data: sharding, deduplication, scoring, search, packing, mixing, archives."""

import sys

from pyspark import cloudpickle

# Functions go to the workers by value, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
