"""Operators for preparing training data: language, copies, leaks, privacy, mixing, tokens.

Nothing else in the library imports this subpackage. Its Python functions travel to the
executors by value, so executors need not have the library installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
