"""Operators for preparing training data.

Functions that run inside tasks travel with the tasks (pickled by value), so
executors need numpy, pyarrow and the like, but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
