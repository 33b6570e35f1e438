"""Company-data resolution and enrichment on Spark."""

import sys

from pyspark import cloudpickle

# functions reach the workers by value, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
