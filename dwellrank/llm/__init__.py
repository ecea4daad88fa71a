"""Operators for preparing large text corpora; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Kernels travel with the plan, so executors need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
