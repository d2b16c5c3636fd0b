"""Operators for preparing training data: mixing, language, search, scoring, filters, duplicates, packing."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers with the job, so a cluster needs no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
