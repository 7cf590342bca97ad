"""tastegrid: recommendation, retrieval and answer-quality analytics on PySpark DataFrames."""

import sys

from pyspark import cloudpickle

# task functions travel with their code, so executors need no copy of the package on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
