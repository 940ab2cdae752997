"""Model-evaluation analytics as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel with the job, so workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
