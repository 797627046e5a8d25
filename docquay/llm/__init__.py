"""Operators for preparing training data; nothing outside this package imports it.

Functions that run in tasks are sent to the executors by value, so a session works
without installing this package on them.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
