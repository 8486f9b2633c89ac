"""Spark operators that keep fast-changing public datasets current.

Every operator is a function from DataFrame to DataFrame or from Column to
Column.  The current time is always an argument, so a rerun gives the same rows.
"""

import sys

from pyspark import cloudpickle

# Tasks get the package's small Python helpers with their code, so executors
# need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
