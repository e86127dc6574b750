"""Training-data operators: each module is one operator with its own interface, `queries` registers them.

The functions that run in Python workers are shipped by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
