"""Operators for preparing training text at scale, and their registered queries.

Functions of this package that run inside Python tasks travel with the job by value, so
executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
