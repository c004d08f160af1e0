"""Operators for preparing training text.

The modules are pickled by value, so that executors can run their Python functions
without having the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
