"""Operators for large text corpora.  Nothing else in the library imports this subpackage.

Functions that run inside Spark tasks are pickled by value, so executors need
numpy and pyarrow but not this package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
