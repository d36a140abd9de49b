"""Operators for preparing training corpora.

Functions that run inside tasks are sent to the executors by value, so that a cluster needs
the Python libraries named in the README but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
