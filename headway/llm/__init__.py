"""Operators that prepare text corpora for language-model training."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors whole, so those need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
