"""Fairness report and disparity summary.

The reference loops over group columns and values; here the group columns
are unpivoted into ``(group_column, group_value)`` and every metric of every
subgroup is computed by one grouped job.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.operators import evaluate as E
from lendscope.session import written
from lendscope.operators.ordered import join_null_safe


def unpivot_groups(df: DataFrame, group_columns: Sequence[str], keep: Sequence[str]) -> DataFrame:
    cols = [c for c in group_columns if c in df.columns]  # missing columns skipped
    if not cols:
        return df.sparkSession.createDataFrame([], "group_column string, group_value string").crossJoin(
            df.select(*keep).limit(0))
    return (df.select(*keep, F.inline(F.array(*[
        F.struct(F.lit(c).alias("group_column"), F.col(c).cast("string").alias("group_value")) for c in cols])))
        .filter(F.col("group_value").isNotNull()))


# N1
def fairness_report(df: DataFrame, group_columns: Sequence[str], y: str = "y", p: str = "p",
                    threshold: float = 0.5, min_group_size: int = 10) -> DataFrame:
    """E1-E7 per (group_column, group_value) with n and actual default rate;
    subgroups smaller than ``min_group_size`` are skipped."""
    long = written(unpivot_groups(df, group_columns, [y, p]), "fairness")      # read by every metric family
    keys = ["group_column", "group_value"]
    sizes = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                    F.avg(F.col(y).cast("double")).alias("actual_default_rate"),
                                    F.avg(F.col(p).cast("double")).alias("mean_predicted_probability"))
    big = sizes.filter(F.col("n") >= min_group_size)
    big = written(big, "fairness-groups")
    eligible = join_null_safe(long, big.select(*keys), keys)
    pm = E.point_metrics(eligible, y, p, threshold, keys)  # confusion + log loss + Brier: one pass
    m = E.threshold_metrics(F.col("tp"), F.col("fp"), F.col("tn"), F.col("fn"))
    base = pm.select(*keys, *[v.alias(k) for k, v in m.items()], "log_loss", "brier_score")
    rank = E.rank_metrics(eligible, y, p, keys)
    ece = E.expected_calibration_error(eligible, y, p, keys=keys)
    out = join_null_safe(big, base, keys)
    for t in (rank, ece):
        out = join_null_safe(out, t, keys)
    return out


# N2
def summarize_disparities(report: DataFrame, metric: str = "recall") -> DataFrame:
    """min, max and spread of one metric per group column, largest spread first."""
    return (report.groupBy("group_column")
            .agg(F.min(metric).alias("min_value"), F.max(metric).alias("max_value"))
            .withColumn("spread", F.col("max_value") - F.col("min_value"))
            .withColumn("metric", F.lit(metric))
            .orderBy(F.desc("spread")))
