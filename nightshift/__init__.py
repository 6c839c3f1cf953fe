"""nightshift: a Spark-native, batch-dated incremental retail warehouse.

Every program is a pure function from DataFrames (plus a ``Batch``) to a
DataFrame; publishing a result is a separate, atomic step (``plans.store``).
"""

from nightshift.batch import Batch

__all__ = ["Batch"]
