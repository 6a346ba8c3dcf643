"""cadenza: mood-based recommendations as Spark DataFrame plans.

Texts are labeled with emotion words, the labels are cleaned and checked, turned into
fixed-length vectors, kept in a vector index table, and a table of free-text sentences is
answered with the k most similar items each. Every step takes and returns DataFrames or
Columns.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

# Python workers need not have this package installed: functions that run in tasks
# (Arrow-batched scoring, stream batch handlers) are shipped by value with the task.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

from cadenza.session import get_spark, shared_dir, scratch_path  # noqa: E402

__all__ = ["get_spark", "shared_dir", "scratch_path"]
