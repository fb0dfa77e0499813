"""Operators for preparing language-model training data.

Nothing outside this package imports it. Functions of the package travel to
the Python workers by value, so a cluster needs no extra file on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
