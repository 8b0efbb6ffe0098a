"""Product-page analytics as Spark DataFrame and Structured Streaming jobs."""

import sys

from pyspark import cloudpickle

# Python workers get our functions with the job, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
