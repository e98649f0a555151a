"""Operators for large text corpora; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers as code, so executors
# need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
