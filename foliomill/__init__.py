"""Document preparation, retrieval and evaluation as Spark jobs."""

import sys

from pyspark import cloudpickle

# Python tasks carry the functions they run, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
