"""Operators for training-data pipelines: scoring, extraction, near duplicates, mixing, sharding and token output.

Functions that run inside Spark tasks are shipped by value, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
