"""obslake: Spark jobs that turn messy article records into company revenue observations."""

import sys

from pyspark import cloudpickle

# Python workers get the package's functions with the task, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
