"""Instruction-data preparation and model-evaluation analytics on Spark."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run on executors travel with their code, so the executors need
# pandas, numpy and pyarrow but no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
