"""Training-data operators over `documents`-like tables; nothing else in the library imports them."""

import sys

from pyspark import cloudpickle

# Executors need not have this package on their path: its functions travel with each job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
