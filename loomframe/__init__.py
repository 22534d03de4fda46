"""Text preparation and training-log analytics expressed as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# executors need no copy of this package: the few functions that run there travel with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])
