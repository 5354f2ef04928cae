"""Operators of a training-data pipeline; nothing outside this folder imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code; executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
