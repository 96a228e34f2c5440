"""Training-data operators: dedup, quality, language, licences, contamination, scoring, packing and search."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
