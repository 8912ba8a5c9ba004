"""Operators of a training-data pipeline: quality, sharding, mixing, decontamination, licences, duplicates, scoring.

Task functions travel to the executors by value, so the cluster needs no
installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
