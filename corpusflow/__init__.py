"""Text-corpus preparation, batch inference and evaluation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Python functions travel with the plan, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
