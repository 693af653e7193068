"""Filtering, cleaning, target creation and outlier clipping.

All operators are narrow column expressions except ``remove_duplicate_rows``
(one shuffle, with map-side de-duplication) and the quantile fit of the
clipper (see ``ordered.exact_quantiles``).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators.ordered import exact_quantiles, quantile_table_wide

log = logging.getLogger(__name__)


def _null_double() -> Column:
    return F.lit(None).cast("double")


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c.cast("double"), _null_double())


# C1
def filter_to_target_state(df: DataFrame, state: str = R.TARGET_STATE,
                           column: str = R.STATE_COLUMN) -> DataFrame:
    """Keep rows of one state; a missing column leaves the table unchanged."""
    if column not in df.columns:
        log.warning("state column %s not found - skipping filter", column)
        return df
    return df.filter(F.col(column) == state)


# C2
def remove_duplicate_rows(df: DataFrame) -> DataFrame:
    """Drop full-row duplicates (partial aggregation removes them map-side)."""
    return df.dropDuplicates()


# C3
def parse_percent(c: Column) -> Column:
    """``' 13.5% '`` -> 13.5; unparsable -> NULL (text 'nan' removed first)."""
    s = F.replace(F.replace(F.trim(c.cast("string")), F.lit("%"), F.lit("")),
                  F.lit("nan"), F.lit(""))
    return nan_to_null(s.try_cast("double"))


def clean_percentage_columns(df: DataFrame, columns: Sequence[str] = R.PERCENTAGE_COLUMNS) -> DataFrame:
    out = df
    types = dict(df.dtypes)
    for c in columns:
        if c not in df.columns:
            log.warning("percentage column %s not found - skipping", c)
            continue
        if types[c] in ("string",):
            out = out.withColumn(c, parse_percent(F.col(c)))
        else:
            out = out.withColumn(c, nan_to_null(F.col(c)))
    return out


# C4
def emp_length_expr(c: Column) -> Column:
    m = F.create_map(*[x for k, v in R.EMP_LENGTH_MAP.items() for x in (F.lit(k), F.lit(v))])
    return m[F.trim(c.cast("string"))].cast("double")


def parse_emp_length(df: DataFrame, raw: str = R.EMP_LENGTH_RAW_COLUMN,
                     out: str = R.EMP_LENGTH_NUMERIC_COLUMN) -> DataFrame:
    if raw not in df.columns:
        log.warning("%s not found - %s set to NULL", raw, out)
        return df.withColumn(out, _null_double())
    return df.withColumn(out, emp_length_expr(F.col(raw)))


# C5
def create_target_variable(df: DataFrame, status: str = R.STATUS_COLUMN,
                           target: str = R.TARGET_COLUMN,
                           mapping: Mapping[str, int] = R.LOAN_STATUS_TARGET_MAP) -> DataFrame:
    """Keep resolved loans only and add the 0/1 outcome (literal map lookup)."""
    if status not in df.columns:
        raise KeyError(f"status column '{status}' not found")
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(int(v)))])
    return (df.withColumn(target, m[F.col(status)].cast("int"))
            .filter(F.col(target).isNotNull()))


# C6
def drop_excluded_columns(df: DataFrame, columns: Sequence[str] = R.EXCLUDED_COLUMNS) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def cast_numeric(df: DataFrame, columns: Sequence[str] = R.NUMERIC_FEATURES) -> DataFrame:
    """Numeric features as double with NaN turned into NULL (one missing marker)."""
    present = set(df.columns)
    return df.select(*[nan_to_null(F.col(c)).alias(c) if c in columns else F.col(c)
                       for c in df.columns]) if present & set(columns) else df


# C7
def clean_dataset(df: DataFrame, target_state: str | None = None, drop_excluded: bool = True,
                  trim_term: bool = False) -> DataFrame:
    """C1 -> C2 -> C3 -> C4 -> C5 -> C6, in that order (dedup runs with ``id``).

    ``target_state=None`` keeps every state.  ``trim_term`` trims the leading
    space of ``term`` (the reference leaves it in; off by default).
    """
    out = df
    if target_state is not None:
        out = filter_to_target_state(out, target_state)
    out = remove_duplicate_rows(out)
    out = clean_percentage_columns(out)
    out = parse_emp_length(out)
    out = create_target_variable(out)
    if drop_excluded:
        out = drop_excluded_columns(out)
    out = cast_numeric(out)
    if trim_term and "term" in out.columns:
        out = out.withColumn("term", F.trim("term"))
    return out


# C8 / C9
@dataclass
class ClipBounds:
    """Fitted winsorisation bounds: column -> (lower, upper)."""

    bounds: dict
    k: float

    def apply(self, df: DataFrame) -> DataFrame:
        return apply_bounds(df, self)

    def as_rows(self) -> list:
        return [(c, lo, hi) for c, (lo, hi) in self.bounds.items()]


def fit_bounds(df: DataFrame, columns: Sequence[str], k: float = R.WINSOR_IQR_MULTIPLIER) -> ClipBounds:
    """Q1 - k*IQR, Q3 + k*IQR per column; exact quantiles, one distributed job.

    Only the per-column bounds (2 numbers per column) reach the driver.
    """
    cols = [c for c in columns if c in df.columns]
    q = quantile_table_wide(exact_quantiles(df, cols, [0.25, 0.75]), ["column"],
                            [0.25, 0.75], ["q1", "q3"])
    rows = q.collect()
    b = {}
    for r in rows:
        iqr = r["q3"] - r["q1"]
        b[r["column"]] = (r["q1"] - k * iqr, r["q3"] + k * iqr)
    return ClipBounds({c: b[c] for c in cols if c in b}, k)


def bounds_frame(spark, fitted: ClipBounds) -> DataFrame:
    return spark.createDataFrame(fitted.as_rows(), "column string, lower_bound double, upper_bound double")


def apply_bounds(df: DataFrame, fitted: ClipBounds) -> DataFrame:
    """Clip into the stored bounds; NULL stays NULL (``greatest(NULL, x)`` is x)."""
    out = []
    for c in df.columns:
        if c in fitted.bounds:
            lo, hi = fitted.bounds[c]
            v = F.col(c).cast("double")
            out.append(F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(lo)), F.lit(hi))).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def winsorize_columns(df: DataFrame, columns: Sequence[str] = R.NUMERIC_FEATURES,
                      k: float = R.WINSOR_IQR_MULTIPLIER, fit_on: DataFrame | None = None) -> DataFrame:
    """Fit on ``fit_on`` (default: ``df`` itself) and clip ``df``."""
    return apply_bounds(df, fit_bounds(fit_on if fit_on is not None else df, columns, k))


def clip_counts(df: DataFrame, fitted: ClipBounds) -> DataFrame:
    """(column, lower_bound, upper_bound, n_clipped_low, n_clipped_high, n_clipped) in one scan."""
    cols = list(fitted.bounds)
    aggs = []
    for c in cols:
        lo, hi = fitted.bounds[c]
        v = F.col(c).cast("double")
        aggs += [F.count(F.when(v < lo, 1)).alias(f"{c}__lo"), F.count(F.when(v > hi, 1)).alias(f"{c}__hi")]
    wide = df.agg(*aggs)
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(fitted.bounds[c][0]).alias("lower_bound"),
                 F.lit(fitted.bounds[c][1]).alias("upper_bound"),
                 F.col(f"{c}__lo").alias("n_clipped_low"), F.col(f"{c}__hi").alias("n_clipped_high"))
        for c in cols])))
    return long.withColumn("n_clipped", F.col("n_clipped_low") + F.col("n_clipped_high"))


# C10
def apply_borrower_filters(df: DataFrame, categories: Mapping[str, Sequence] | None = None,
                           ranges: Mapping[str, tuple] | None = None) -> DataFrame:
    """IN-lists (empty list = no filter) AND inclusive ranges (NULL fails a range)."""
    cond = F.lit(True)
    for c, vals in (categories or {}).items():
        if c in df.columns and vals:
            cond = cond & F.col(c).isin(list(vals))
    for c, (lo, hi) in (ranges or {}).items():
        if c in df.columns:
            cond = cond & F.col(c).between(lo, hi)
    return df.filter(cond)


# C11
def filter_domains(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Long table ``(column, kind, min_value, max_value, category)``.

    Numeric bounds come from one aggregate; category domains are distinct
    values per column (distributed, never collected into one array).
    """
    num = df.agg(*[x for c in numeric for x in (F.min(F.col(c).cast("double")).alias(f"{c}__min"),
                                                  F.max(F.col(c).cast("double")).alias(f"{c}__max"))])
    num_long = num.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit("range").alias("kind"),
                 F.col(f"{c}__min").alias("min_value"), F.col(f"{c}__max").alias("max_value"),
                 F.lit(None).cast("string").alias("category")) for c in numeric])))
    cat_long = (df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"))
        for c in categorical])))
        .filter(F.col("category").isNotNull()).distinct()
        .select("column", F.lit("domain").alias("kind"), _null_double().alias("min_value"),
                _null_double().alias("max_value"), "category"))
    return num_long.unionByName(cat_long)


# C15
def deterministic_sample(df: DataFrame, n: int, seed: int = R.RANDOM_STATE,
                         id_col: str = "id") -> DataFrame:
    """Capped sample by hash order; n >= rows returns all rows (a sampling
    operator: the limit is the feature).  Top-n by hash runs as a
    per-partition top-k followed by a merge of n rows per partition."""
    return df.orderBy(F.xxhash64(F.col(id_col), F.lit(seed))).limit(n)


# C16
def form_defaults(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Per-column prefill: exact median for numerics, mode (smallest on ties)
    for categoricals; long table ``(column, median_value, mode_value)``."""
    from lendscope.operators.describe import mode_table
    med = (exact_quantiles(df, numeric, [0.5])
           .select("column", F.col("value").alias("median_value"),
                   F.lit(None).cast("string").alias("mode_value")))
    modes = mode_table(df, categorical).select("column", _null_double().alias("median_value"),
                                               F.col("mode").alias("mode_value"))
    return med.unionByName(modes)
