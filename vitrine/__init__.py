"""vitrine: DataFrame operators for the data side of embedding-based product search.

Every operator takes DataFrames and returns a lazy DataFrame. Missing measurements
are NULL throughout (never NaN), so Spark aggregates skip them.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value, so workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
