"""Operators for preparing training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package with the job, whether or not executors have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
