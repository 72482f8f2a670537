"""curvelake: statistics on tables, written as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python tasks receive the library's functions with the job: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
