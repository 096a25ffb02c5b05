"""Scouting analytics as Spark DataFrame operators.

Every operator is a plain function from DataFrames (or Columns) to a DataFrame (or Column); nothing runs
until the caller triggers an action, apart from model training and the sinks.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
