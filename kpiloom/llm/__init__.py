"""Operators of a large-scale training-data pipeline (see README, "Training data").

Each module is one operator with a general interface on DataFrames;
``queries.py`` registers the thin ``opN_<name>`` queries over the given
tables.  Nothing outside this package imports it except the entry module.
"""

import sys

from pyspark import cloudpickle

# ship the package's functions to the Python workers by value, so executors
# need no package install
cloudpickle.register_pickle_by_value(sys.modules[__name__])
