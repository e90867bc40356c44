"""Operators for preparing training data: ten operators, their queries and SQL.

Nothing else in the library imports this package.
"""

import sys

from pyspark import cloudpickle

# Task code travels by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
