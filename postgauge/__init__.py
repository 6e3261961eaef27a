"""Text classification over large post tables, expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with them, so executors need no
# installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
