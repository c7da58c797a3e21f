"""Operators for training-data pipelines over whole document tables.

Functions of this package travel to executors by value, so a cluster needs no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
