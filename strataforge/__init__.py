"""strataforge: a Spark-native engine from raw documents to queryable, traceable knowledge."""

import sys

from pyspark import cloudpickle

# Executors get the package's functions with the plan, so nothing has to be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
