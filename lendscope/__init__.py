"""lendscope: credit-risk analytics as Spark DataFrame operators.

Every public operator takes a DataFrame (plus parameters) and returns a
DataFrame, or is a ``pyspark.ml`` Estimator/Transformer.  Nothing returns
row-level data to the driver; the driver only ever sees tables bounded by
#columns, #clusters, #thresholds or #policy bands.
"""

from lendscope.session import get_session, checkpoint_dir
from lendscope.roles import ColumnRoles, LOAN_ROLES

__all__ = ["get_session", "checkpoint_dir", "ColumnRoles", "LOAN_ROLES"]
