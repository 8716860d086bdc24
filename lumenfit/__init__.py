"""lumenfit: explainable tabular machine learning and data profiling on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job; executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
