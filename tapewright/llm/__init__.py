"""Operators for preparing training text: extraction, filtering, deduplication, scoring and mixing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to executors by value, so a cluster needs no copy of it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
