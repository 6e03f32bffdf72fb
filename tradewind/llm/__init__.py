"""Operators for preparing training text, and their registered queries.

Nothing else in the library imports this folder. The functions that run inside tasks travel to the
executors by value, so that a cluster needs no copy of the folder on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
