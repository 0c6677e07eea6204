"""docengine: document and register analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions travel with their jobs, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
