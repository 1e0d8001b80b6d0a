"""Layered (bronze -> silver -> gold) analytics jobs on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from stratiform.spec import LOAD_COLUMNS, EntitySpec

__all__ = ["LOAD_COLUMNS", "EntitySpec"]

# Functions sent to tasks travel by value, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
