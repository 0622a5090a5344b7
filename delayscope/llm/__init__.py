"""Training-data operators: deduplication, decontamination, scoring, packing and formatting."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value: nothing needs to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
