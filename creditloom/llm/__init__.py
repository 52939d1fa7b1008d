"""Operators that prepare text for training language models.

Functions that run in Spark's Python workers are sent to them by value, so executors need
no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
