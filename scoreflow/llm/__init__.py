"""Training-data operators: filtering, deduplication, decontamination, tokenising, archives.

Functions that run inside tasks are shipped by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
