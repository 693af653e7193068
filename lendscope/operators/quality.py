"""Data-quality checks and dataset overview (DQ1-DQ9).

``validate_dataset`` scans the table once for missing counts and business
rules and shuffles once for duplicate detection; the result is one long
``(check, column, value)`` table.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators.describe import target_balance


# DQ1
def schema_drift(df: DataFrame, expected: Sequence[str] = R.EXPECTED_RAW_COLUMNS) -> DataFrame:
    """Expected columns absent from ``df`` (reported, never raised)."""
    missing = [c for c in expected if c not in df.columns]
    return df.sparkSession.createDataFrame([(c,) for c in missing], "missing_column string")


# DQ2 / DQ9
def _missing_counts(df: DataFrame) -> list:
    """(column, aggregate) of the missing values of every column; NaN counts as missing."""
    def is_missing(c, t):
        col = F.col(f"`{c}`")
        return (col.isNull() | F.isnan(col)) if t in ("double", "float") else col.isNull()
    return [(c, F.count(F.when(is_missing(c, t), 1))) for c, t in df.dtypes]


def missing_summary(df: DataFrame, decimals: int = 2, only_missing: bool = True) -> DataFrame:
    """``(column, missing_count, missing_pct)`` from one aggregate; NaN counts as missing."""
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[e.alias(f"m{i}") for i, (_, e) in enumerate(_missing_counts(df))])
    long = wide.select(F.col("__n"), F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing_count"))
        for i, c in enumerate(df.columns)])))
    out = long.select("column", "missing_count",
                      F.bround(F.when(F.col("__n") > 0, F.col("missing_count") / F.col("__n") * 100), decimals)
                      .alias("missing_pct"))
    if only_missing:
        out = out.filter(F.col("missing_count") > 0)
    return out.orderBy(F.desc("missing_count"))


def missing_matrix(df: DataFrame, columns: Sequence[str] | None = None, id_col: str | None = None) -> DataFrame:
    """Row-level NULL indicator projection (DQ9 matrix data)."""
    cols = list(columns or df.columns)
    keep = [id_col] if id_col else []
    return df.select(*keep, *[F.col(c).isNull().cast("int").alias(c) for c in cols if c != id_col])


# DQ3
def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each identical group (NULLs compare equal).

    ``groupBy(all columns).count()`` runs with partial aggregation, so a row
    repeated a billion times is collapsed before the shuffle.
    """
    g = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_row_count"))


# DQ4
def dtype_report(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(list(df.dtypes), "column string, dtype string")


# DQ5
def _rule_checks(df: DataFrame, state: str, statuses: Sequence[str]) -> list:
    """(check, aggregate) of the rule violations; a check whose column is absent is left out."""
    checks = []
    if "loan_amnt" in df.columns:
        checks.append(("negative_or_zero_loan_amnt", F.count(F.when(F.col("loan_amnt") <= 0, 1))))
    if "annual_inc" in df.columns:
        checks.append(("negative_annual_inc", F.count(F.when(F.col("annual_inc") < 0, 1))))
    if R.STATUS_COLUMN in df.columns:
        ok = F.col(R.STATUS_COLUMN).isin(list(statuses))
        checks.append(("loan_status_out_of_scope_rows", F.count(F.when(~F.coalesce(ok, F.lit(False)), 1))))
    if R.STATE_COLUMN in df.columns:
        checks.append(("rows_outside_target_state",
                       F.count(F.when(~F.col(R.STATE_COLUMN).eqNullSafe(F.lit(state)), 1))))
    return checks


def business_rule_counts(df: DataFrame, state: str = R.TARGET_STATE,
                         statuses: Sequence[str] = tuple(R.LOAN_STATUS_TARGET_MAP)) -> DataFrame:
    """Counts of rule violations in one scan; checks whose column is absent are skipped."""
    checks = _rule_checks(df, state, statuses)
    if not checks:
        return df.sparkSession.createDataFrame([], "check string, value long")
    wide = df.agg(*[e.alias(n) for n, e in checks])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check"), F.col(n).cast("long").alias("value")) for n, _ in checks])))


# DQ6
def validate_dataset(df: DataFrame, expected: Sequence[str] = R.EXPECTED_RAW_COLUMNS) -> DataFrame:
    """Long report ``(section, item, value double)``: n_rows, n_columns,
    missing columns, missing counts, duplicate rows, business rules.

    Two passes: one aggregate for everything that counts rows, and the
    grouping that duplicates need.
    """
    spark = df.sparkSession
    items = [("shape", "n_rows", F.count(F.lit(1)))]
    items += [("missing_count", c, e) for c, e in _missing_counts(df)]
    items += [("invalid_values", n, e) for n, e in _rule_checks(df, R.TARGET_STATE, tuple(R.LOAN_STATUS_TARGET_MAP))]
    counted = (df.agg(*[e.cast("double").alias(f"v{i}") for i, (_, _, e) in enumerate(items)])
               .select(F.inline(F.array(*[F.struct(F.lit(s).alias("section"), F.lit(n).alias("item"), F.col(f"v{i}").alias("value"))
                                          for i, (s, n, _) in enumerate(items)])))
               .filter((F.col("section") != "missing_count") | (F.col("value") > 0)))
    ncol = spark.createDataFrame([("shape", "n_columns", float(len(df.columns)))],
                                 "section string, item string, value double")
    drift = schema_drift(df, expected).select(F.lit("missing_column").alias("section"),
                                              F.col("missing_column").alias("item"),
                                              F.lit(1.0).alias("value"))
    dups = duplicate_row_count(df).select(F.lit("duplicates").alias("section"),
                                          F.lit("duplicate_row_count").alias("item"),
                                          F.col("duplicate_row_count").cast("double").alias("value"))
    return counted.unionByName(ncol).unionByName(drift).unionByName(dups)


# DQ7
def dataset_overview(df: DataFrame, target: str = R.TARGET_COLUMN) -> DataFrame:
    """n_rows, n_columns, columns with missing values, duplicate rows and the
    target shares (4 dp) as one long ``(item, value)`` table."""
    spark = df.sparkSession
    base = df.agg(F.count(F.lit(1)).cast("double").alias("n_rows")).select(
        F.lit("n_rows").alias("item"), F.col("n_rows").alias("value"))
    ncol = spark.createDataFrame([("n_columns", float(len(df.columns)))], "item string, value double")
    nmiss = missing_summary(df).agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit("n_columns_with_missing").alias("item"), "value")
    dups = duplicate_row_count(df).select(F.lit("duplicate_row_count").alias("item"),
                                          F.col("duplicate_row_count").cast("double").alias("value"))
    bal = target_balance(df, target).select(
        F.concat(F.lit("target_share_"), F.col(target).cast("string")).alias("item"),
        F.col("share").alias("value"))
    return base.unionByName(ncol).unionByName(nmiss).unionByName(dups).unionByName(bal)


# DQ8
def variable_description_table(df: DataFrame, glossary: Mapping[str, str] | None = None) -> DataFrame:
    """Schema rows left-joined to a glossary; unknown columns get a default text."""
    from lendscope.functions.text import GLOSSARY, GLOSSARY_DEFAULT
    spark = df.sparkSession
    gl = dict(GLOSSARY if glossary is None else glossary)
    schema = spark.createDataFrame([(c, t) for c, t in df.dtypes], "variable string, dtype string")
    g = spark.createDataFrame(list(gl.items()) or [("", "")], "variable string, description string")
    return (schema.join(F.broadcast(g), "variable", "left")  # glossary: fixed, small
            .withColumn("description", F.coalesce("description", F.lit(GLOSSARY_DEFAULT))))
