"""recoflow: recommendation and data-integration operators as Spark DataFrame functions."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors get the functions of a job themselves and need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
