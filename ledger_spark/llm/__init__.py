"""Operators of a training-data pipeline over documents, embeddings and conversations."""

import sys

from pyspark import cloudpickle

# Executors need not have the package: its functions and classes travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
