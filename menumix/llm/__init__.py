"""Operators for preparing training text at scale. Nothing else in the library imports this subpackage.

Functions of this subpackage travel to the workers by value, so a worker needs
no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
