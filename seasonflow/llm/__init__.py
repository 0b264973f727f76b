"""Operators of a training-data pipeline, each a set of Spark jobs over documents,
pages or embeddings. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need neither
# this package on their path nor any file of the driver.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
