"""Operators for preparing large text corpora. Nothing else in the library imports this subpackage.

Functions of these modules travel to the executors by value, so a cluster needs no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
