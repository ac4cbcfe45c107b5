"""Operators for training-data pipelines.

Task code of this package travels with the job: its functions are pickled by
value, so executors need only Spark, numpy and pyarrow, not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
