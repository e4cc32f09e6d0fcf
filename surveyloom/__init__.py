"""surveyloom: weave several survey or registry tables into one comparable table on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Tasks get the library's few Python functions by value: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
