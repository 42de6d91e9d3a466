"""Analytics over ordered media logs: segments, nearest and interval joins, search, alignment, scoring."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors get the code inside the tasks; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
