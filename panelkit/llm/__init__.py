"""Training-data operators: deduplication, language ID, mixing, packing, scoring,
secret scans and tool-call linking. Nothing else in the library imports this package.

Functions that run on executors are shipped by value, so a worker needs only the
third-party libraries, not this package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
