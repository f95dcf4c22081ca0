"""Shelfmark: catalogue tagging and similarity search as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Arrow functions of this package travel to the executors inside the task, so
# a cluster needs no copy of the package on its workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
