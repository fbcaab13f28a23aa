"""sparkraster: raster, parcel and corpus analytics as PySpark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Task functions travel with their module code, so executors need no copy of
# this package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
