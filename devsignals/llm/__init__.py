"""Operators for training data: language, quality, duplicates, contamination, tokens, archives, licences.

Nothing else in the library imports this subpackage. Its functions travel to the
executors by value, so that tasks do not need the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
