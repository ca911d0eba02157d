"""tabforge: tabular analytics and model building as Spark DataFrame operators and ML stages."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with their code, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
