"""Operators for training data: packing, filtering, scoring and deduplication of documents."""

import sys

from pyspark import cloudpickle

# Executors get this package's functions with the task, not from an installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
