"""lakeworks: PySpark-native analytics jobs over files in a data lake."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Helper functions travel to Python workers by value: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
