"""Operators for preparing language-model training data."""

import sys

from pyspark import cloudpickle

# Tasks get this package's functions with the job, so that executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
