"""Operators that prepare text for the training of language models.

Nothing else in the library imports this subpackage. Its functions travel to the executors by
value, so workers need no copy of the library on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
