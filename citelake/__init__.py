"""Versioned literature-metadata engine on PySpark."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code with them, so the package needn't be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
