"""Operators of a large training-data pipeline over documents, conversations and vectors."""

import sys

from pyspark import cloudpickle

# Executors get these functions as code, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
