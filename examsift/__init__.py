"""Curation and analysis of machine-generated exam items on Spark DataFrames.

Functions of this package that run on executors are pickled by value, so a cluster
needs the package on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
