"""folioforge: a Spark-native engine for document, graph and vector analytics."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run on executors travel with the task, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
