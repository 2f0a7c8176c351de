"""Listing analytics on Spark: snapshots to master, text to scores, vectors to search."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Send this package's functions with the tasks, so executors need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
