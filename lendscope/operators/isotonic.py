"""Isotonic calibration by distributed pooling of adjacent violators (M9).

Rows collapse to distinct scores, scores are cut into ranges and pooled range
by range; what a range pools stays pooled in the whole, so neighbouring ranges
are then merged sixteen at a time, block summaries alone, until one list is
left.  With 0/1 outcomes the blocks have strictly rising shares, of which n
rows can hold no more than about n^(2/3) (noisy data some n^(1/3)), so the
last list is small whatever the table's size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.session import written

FAN_IN = 16
BLOCKS = "grp long, lo double, hi double, n double, total double"


def pool(lo: np.ndarray, hi: np.ndarray, n: np.ndarray, total: np.ndarray) -> list[tuple]:
    """Pool blocks in order of ``lo`` until their means rise strictly."""
    out: list[list[float]] = []
    for a, b, c, s in zip(lo.tolist(), hi.tolist(), n.tolist(), total.tolist()):
        block = [a, b, c, s]
        while out and out[-1][3] * block[2] >= block[3] * out[-1][2]:
            last = out.pop()
            block = [last[0], block[1], last[2] + block[2], last[3] + block[3]]
        out.append(block)
    return out


def isotonic_blocks(rows: DataFrame, score: str, y: str, parts: int | None = None) -> DataFrame:
    """(lo, hi, n, value): score ranges of rising mean outcome ``value`` over all
    rows that have both; empty without any."""
    x = F.nanvl(F.col(score).cast("double"), F.lit(None).cast("double")) + F.lit(0.0)      # -0.0 is 0.0
    counts = (rows.select(x.alias("lo"), F.col(y).cast("double").alias("y")).dropna().groupBy("lo")
              .agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("y").alias("total")))
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = written(counts.repartitionByRange(parts, "lo")
                     .select(F.spark_partition_id().cast("long").alias("grp"), "lo", F.col("lo").alias("hi"), "n", "total"),
                     "isotonic")

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("lo")
        found = pool(*(part[c].to_numpy() for c in ("lo", "hi", "n", "total")))
        out = pd.DataFrame(found, columns=["lo", "hi", "n", "total"])
        out.insert(0, "grp", key[0])
        return out

    while True:
        blocks = written(blocks.groupBy("grp").applyInPandas(merge, BLOCKS), "isotonic")
        if parts == 1:
            return blocks.select("lo", "hi", "n", (F.col("total") / F.col("n")).alias("value"))
        blocks = blocks.withColumn("grp", F.floor(F.col("grp") / FAN_IN))
        parts = -(-parts // FAN_IN)


@dataclass
class IsotonicCurve:
    """Knots of the fitted curve: two per block, straight lines between."""

    scores: list[float]
    values: list[float]

    def apply(self, score: Column) -> Column:
        """Calibrated value; scores beyond the ends take the end's value, null
        and NaN give null, and so does a curve without knots."""
        xs, ys = np.array(self.scores), np.array(self.values)

        @F.pandas_udf("double")
        def look_up(s: pd.Series) -> pd.Series:
            return pd.Series(np.interp(s.to_numpy(dtype=float), xs, ys))

        if not len(xs):
            return F.lit(None).cast("double")
        x = F.nanvl(score.cast("double"), F.lit(None).cast("double"))
        return F.when(x.isNotNull(), look_up(F.coalesce(x, F.lit(0.0))))


def fit_isotonic(rows: DataFrame, score: str, y: str, parts: int | None = None) -> IsotonicCurve:
    blocks = sorted(isotonic_blocks(rows, score, y, parts).collect(), key=lambda r: r.lo)     # blocks, see above
    knots = [(x, r.value) for r in blocks for x in ((r.lo,) if r.lo == r.hi else (r.lo, r.hi))]
    return IsotonicCurve([k[0] for k in knots], [k[1] for k in knots])
