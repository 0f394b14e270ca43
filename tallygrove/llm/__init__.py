"""Operators that prepare text corpora for language-model training."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the workers by value, so that a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
