"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel with the tasks, so executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
