"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Functions that run on executors are shipped by value, so
the executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
