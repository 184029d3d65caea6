"""Operators for preparing language-model training data, as Spark jobs."""

import sys

from pyspark import cloudpickle

# tasks get these functions with the job: executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
