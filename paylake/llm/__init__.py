"""Training-data operators: one module per operator, queries in ``queries.py``."""

import sys

from pyspark import cloudpickle

# Python workers get these modules' functions with the task, installed there or not.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
