"""Block-ledger analytics on Spark DataFrames.

Every operator is a function from DataFrame to DataFrame (or Column to Column),
so all of them compose with ``df.transform`` and are planned by Catalyst.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no copy
# of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
