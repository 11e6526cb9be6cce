"""Operators for training-data pipelines (each a ``DataFrame -> DataFrame`` function).

Nothing else in the library imports this subpackage.  Its functions are pickled
by value, so Python workers need no copy of it on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
