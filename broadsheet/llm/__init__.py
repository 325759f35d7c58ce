"""Operators for preparing training data for language models.

Nothing else in the library imports this subpackage. Its functions travel to the executors
by value, so executors need numpy, pandas and pyarrow, but not this library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
