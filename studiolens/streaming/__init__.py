"""Structured Streaming jobs: occupancy polls, ride numbers, outage alerts.

State functions travel to the executors by value, so executors need not have the library installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
