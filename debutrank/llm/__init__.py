"""Operators of a training-data pipeline: scoring, mixing, sharding, deduplication, privacy, quality."""

import sys

from pyspark import cloudpickle

# Functions travel to the executors by value, so that the workers need not have the package
# on their path. The helpers that they name are in the package above.
cloudpickle.register_pickle_by_value(sys.modules["debutrank"])
