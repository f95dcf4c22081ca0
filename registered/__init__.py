"""Queries over the given tables, each with its SQL where SQL can say it."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
