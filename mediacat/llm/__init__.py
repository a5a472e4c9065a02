"""Operators and queries for preparing language-model training text.

The functions that run in Python workers travel with the plan, so executors need not have
this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
