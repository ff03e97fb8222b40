"""Operators for preparing training text, each a DataFrame-to-DataFrame function."""

import sys

from pyspark import cloudpickle

#: What runs in Python workers travels with the job; executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
