"""Spark jobs for the data side of putting models into production."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel with their code, so the package does
# not have to be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
