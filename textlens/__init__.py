"""textlens: analysing and normalising large collections of nested, text-bearing records on Spark."""

import sys

from pyspark import cloudpickle

# Python workers on other machines then need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
