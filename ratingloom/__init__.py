"""ratingloom: ratings analytics as DataFrame -> DataFrame operators on Spark."""

import sys

from pyspark import cloudpickle

# The small functions that run in Python workers travel with their tasks, so the workers
# need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
