"""Operators for training-data pipelines; nothing else in the library imports this package.

Functions that run inside tasks are shipped by value, so executors need the libraries
that a function imports but not this package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
