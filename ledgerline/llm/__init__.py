"""Training-data pipeline operators: deduplication, scans, search, sharding,
mixing, web-archive derivatives. Nothing outside this package imports it."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so executors
# need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
