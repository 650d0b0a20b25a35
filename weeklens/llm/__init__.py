"""Operators of a training-data pipeline (deduplication, packing, extraction,
decontamination, quality, sharding) on Spark DataFrames.

Nothing else in the library imports this package; it uses only general helpers
(session, shared checkpoint folder) from outside. Task functions are pickled by
value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
