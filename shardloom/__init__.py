"""shardloom: a PySpark-native engine for preparing machine-learning datasets."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions sent to executors carry their code along, so that workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
