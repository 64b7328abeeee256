"""Operators of a training-data pipeline; nothing else in the library imports them.

The functions that run in tasks travel with the tasks, so workers need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
