"""Training-data operators: quality, deduplication, extraction, mixing, sharding.

Nothing else in the library imports this subpackage.  Its functions are sent to
Python workers by value, so executors need not have it installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
