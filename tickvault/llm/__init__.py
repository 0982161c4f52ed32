"""Operators of a training-data pipeline on text tables.

Functions of this package travel to the Python workers by value, so a cluster needs no
copy of it on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
