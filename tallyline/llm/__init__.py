"""Operators of a training-data pipeline: deduplication, mixing, tokens, scoring, archives, near neighbours.

Functions that run inside tasks travel by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
