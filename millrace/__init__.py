"""A PySpark-native engine for text datasets and evaluations.

Functions are shipped to executors by value, so only the driver needs this package, from whatever folder it is started.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
