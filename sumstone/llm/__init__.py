"""Operators of a training-data pipeline: DataFrames in, DataFrames out.

Each module holds one operator with its own interface; ``queries`` binds them to the tables.
Functions of this package travel to the executors by value, so a cluster needs no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
