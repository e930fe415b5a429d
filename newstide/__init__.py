"""News-trend analytics on Spark DataFrames."""

import sys

from pyspark.cloudpickle.cloudpickle import register_pickle_by_value

# The small Python helpers travel with the tasks, so executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
