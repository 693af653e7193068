"""Shared inputs of the registered queries: the cleaned loan book and the
scored loan book (stand-in score), both derived by Spark from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators.clean import clean_dataset, drop_excluded_columns
from lendscope.session import written
from lendscope.sources.tables import loan_book, scored_loans

KEEP = ("id", "addr_state")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 on the loan book; ``id`` and ``addr_state`` kept for keyed operators.

    Not cached: each query prunes columns and pushes filters down to the scan.
    """
    df = clean_dataset(loan_book(spark, sf_dir), drop_excluded=False)
    return drop_excluded_columns(df, [c for c in R.EXCLUDED_COLUMNS if c not in KEEP])


def kept_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``loans`` written once to the shared folder, for queries of many passes:
    the joins of the loan book run once, and each pass reads its own columns."""
    return written(loans(spark, sf_dir), "loans")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_loans(loans(spark, sf_dir))


def sig_round(c, digits: int = 8):
    """Round to ``digits`` significant digits (0, NULL, NaN and inf unchanged)."""
    ex = F.floor(F.log10(F.abs(c)))
    up = F.pow(F.lit(10.0), ex)          # exact power of ten for ex >= 0
    down = F.pow(F.lit(10.0), -ex)       # exact power of ten for ex < 0
    k = F.lit(float(10 ** (digits - 1)))
    ok = c.isNotNull() & (c != 0) & ~F.isnan(c) & (F.abs(c) != float("inf"))
    # explicit floor(t + 0.5) and scaling only by exact powers of ten: plain
    # IEEE arithmetic that every engine evaluates to the same double
    big = F.floor(c / up * k + F.lit(0.5)) / k * up
    small = F.floor(c * down * k + F.lit(0.5)) / k / down
    return F.when(ok, F.when(ex >= 0, big).otherwise(small)).otherwise(c)


def rounded(df: DataFrame, digits: int = 8) -> DataFrame:
    """Round every double column to significant digits: engines sum floats in
    different orders, so results are compared at 8 significant digits."""
    return df.select(*[sig_round(F.col(c), digits).alias(c) if t in ("double", "float") else F.col(c)
                       for c, t in df.dtypes])
