"""Operators on text corpora and embeddings for training-data pipelines."""

import sys

from pyspark import cloudpickle

# The functions that run in tasks travel with the plan, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
