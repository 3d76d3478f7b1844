"""Text-corpus analytics as composable Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors do not
# need the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
