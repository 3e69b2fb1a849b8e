"""Corpus preparation, vector search and answer evaluation on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with their code: executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
