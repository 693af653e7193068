"""Grouped and descriptive aggregation.

Every operator is one or two aggregations; wide multi-column statistics are
computed in a single ``agg`` and turned long with ``inline`` so the table is
scanned once whatever the number of columns.
"""

from __future__ import annotations

from statistics import NormalDist
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators.ordered import (exact_quantiles, quantile_table_wide,
                                         unpivot_numeric, join_null_safe)


def z_value(confidence: float) -> float:
    return NormalDist().inv_cdf(1 - (1 - confidence) / 2)


def order_index(c: Column, order: Sequence[str]) -> Column:
    """0-based position in a fixed order, NULL when absent."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), c)
    return F.when(pos > 0, pos - 1)


def share_of_total(g: DataFrame, count_col: str, out: str, scale: float = 1.0,
                   decimals: int | None = None) -> DataFrame:
    """count / total over a grouped table, the total joined as a one-row side."""
    tot = g.agg(F.sum(count_col).alias("_total"))
    v = F.col(count_col) / F.col("_total") * scale
    return (g.crossJoin(F.broadcast(tot))
            .withColumn(out, F.bround(v, decimals) if decimals is not None else v).drop("_total"))


# A1
def default_rate_by_group(df: DataFrame, group: str, target: str = R.TARGET_COLUMN,
                          decimals: int = 4) -> DataFrame:
    """loan_count (non-NULL outcomes), default_count, default_rate; NULL groups dropped."""
    g = (df.filter(F.col(group).isNotNull())
         .groupBy(group)
         .agg(F.count(target).alias("loan_count"),
              F.sum(F.col(target).cast("long")).alias("default_count")))
    rate = F.when(F.col("loan_count") > 0, F.col("default_count") / F.col("loan_count"))
    return g.withColumn("default_rate", F.bround(rate, decimals)).orderBy(F.desc("default_rate"))


# A2
def default_rate_summary(df: DataFrame, group: str, target: str = R.TARGET_COLUMN,
                         min_group_size: int = 5, order: Sequence[str] | None = None,
                         decimals: int = 4) -> DataFrame:
    """A1 + portfolio average (all rows), plot flag (n >= min size) and sort index."""
    if order is None and group in ("grade",):
        order = R.GRADE_ORDER
    rates = default_rate_by_group(df, group, target, decimals)
    overall = df.agg(F.avg(F.col(target).cast("double")).alias("portfolio_rate"))
    out = (rates.crossJoin(F.broadcast(overall))  # one-row side
           .withColumn("in_plot", F.col("loan_count") >= min_group_size))
    if order:
        out = out.withColumn("sort_index", order_index(F.col(group), order))
    else:
        out = out.withColumn("sort_index", F.lit(None).cast("int"))
    return out


# A3
def wilson_interval(k: Column, n: Column, confidence: float = 0.95):
    z = z_value(confidence)
    nd = n.cast("double")
    p = k / nd
    denom = 1 + z * z / nd
    center = (p + z * z / (2 * nd)) / denom
    half = (z * F.sqrt(p * (1 - p) / nd + z * z / (4 * nd * nd))) / denom
    lo = F.when(n > 0, F.greatest(F.lit(0.0), center - half))
    hi = F.when(n > 0, F.least(F.lit(1.0), center + half))
    return F.when(n > 0, p), lo, hi


def default_rate_ci_by_group(df: DataFrame, group: str, target: str = R.TARGET_COLUMN,
                             confidence: float = 0.95, decimals: int = 4) -> DataFrame:
    """Wilson score interval per group; n counts every row of the group."""
    g = (df.filter(F.col(group).isNotNull()).groupBy(group)
         .agg(F.count(F.lit(1)).alias("loan_count"),
              F.sum(F.col(target).cast("long")).alias("default_count")))
    p, lo, hi = wilson_interval(F.col("default_count"), F.col("loan_count"), confidence)
    return (g.select(group, "loan_count", "default_count",
                     F.bround(p, decimals).alias("default_rate"),
                     F.bround(lo, decimals).alias("ci_lower"),
                     F.bround(hi, decimals).alias("ci_upper"))
            .orderBy(F.desc("default_rate")))


# A4 / A6
def numeric_descriptive_stats(df: DataFrame, columns: Sequence[str], decimals: int = 3) -> DataFrame:
    """mean, median, std/var (ddof 1), min, Q1, Q3, max, population skew,
    excess kurtosis, n -- one aggregate for moments, one exact-quantile job."""
    cols = [c for c in columns if c in df.columns]
    long = unpivot_numeric(df, cols)
    mom = long.groupBy("column").agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std_dev"),
        F.var_samp("value").alias("variance"), F.min("value").alias("min"),
        F.max("value").alias("max"), F.skewness("value").alias("skewness"),
        F.kurtosis("value").alias("excess_kurtosis"), F.count(F.lit(1)).alias("n"))
    probs = [0.5, 0.25, 0.75]
    q = quantile_table_wide(exact_quantiles(df, cols, probs, long_df=long), ["column"], probs,
                            ["median", "q1_25pct", "q3_75pct"])
    out = mom.join(q, "column")
    r = (lambda c: F.bround(F.col(c), decimals).alias(c)) if decimals is not None else F.col
    return out.select(F.col("column").alias("variable"), r("mean"), r("median"), r("std_dev"),
                      r("variance"), r("min"), r("q1_25pct"), r("q3_75pct"), r("max"),
                      r("skewness"), r("excess_kurtosis"), "n")


def skew_kurtosis_verdict(skew: Column, kurt: Column) -> Column:
    s = (F.when(skew > 1, "strongly right-skewed (a long tail of high values)")
         .when(skew > 0.5, "moderately right-skewed")
         .when(skew < -1, "strongly left-skewed (a long tail of low values)")
         .when(skew < -0.5, "moderately left-skewed")
         .otherwise("roughly symmetric"))
    k = (F.when(kurt > 1, "heavier-tailed than normal (more outlier risk)")
         .when(kurt < -1, "lighter-tailed than normal (fewer extreme values)")
         .otherwise("close to normal-tailed"))
    return F.concat(F.lit("Distribution is "), s, F.lit(" and "), k, F.lit("."))


# A5
def categorical_frequency_table(df: DataFrame, column: str, decimals: int = 2) -> DataFrame:
    """count and percentage per value, NULL kept as its own row."""
    g = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return (share_of_total(g, "count", "percentage", 100.0, decimals)
            .orderBy(F.desc("count")))


# A7
def portfolio_kpis(df: DataFrame, target: str = R.TARGET_COLUMN) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.avg(F.col(target).cast("double")).alias("default_rate"),
        F.avg("annual_inc").alias("mean_annual_inc"),
        F.avg("loan_amnt").alias("mean_loan_amnt"),
        F.avg("int_rate").alias("mean_int_rate"),
        F.avg("dti").alias("mean_dti"),
        F.avg("emp_length_years").alias("mean_emp_length_years"))


# A8
def category_distribution(df: DataFrame, column: str, by: str = "count") -> DataFrame:
    g = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return g.orderBy(F.desc("count"), column) if by == "count" else g.orderBy(column)


# A9
def riskiest_group(df: DataFrame, group: str, target: str = R.TARGET_COLUMN) -> DataFrame:
    """argmax of the default rate; ties go to the first key in sort order."""
    rates = default_rate_by_group(df, group, target)
    return rates.agg(
        F.min_by(F.col(group), F.struct(-F.col("default_rate"), F.col(group))).alias("riskiest_group"),
        F.max("default_rate").alias("riskiest_rate"))


# A10
def categorical_spread_ranking(df: DataFrame, columns: Sequence[str],
                               target: str = R.TARGET_COLUMN) -> DataFrame:
    """Per categorical column: max - min of the group default rates, #categories."""
    long = df.select(target, F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("value"))
        for c in columns]))).filter(F.col("value").isNotNull())
    rates = long.groupBy("variable", "value").agg(F.avg(F.col(target).cast("double")).alias("rate"))
    return (rates.groupBy("variable")
            .agg((F.max("rate") - F.min("rate")).alias("rate_spread"),
                 F.count(F.lit(1)).alias("n_categories"))
            .orderBy(F.desc("rate_spread")))


# A11
def target_balance(df: DataFrame, target: str = R.TARGET_COLUMN, decimals: int = 4) -> DataFrame:
    g = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    return share_of_total(g, "count", "share", 1.0, decimals)


def quantile_table_wide_by(q: DataFrame, group: str, columns: Sequence[str]) -> DataFrame:
    """One row per group, one column per variable of a one-quantile table."""
    return q.groupBy(group).agg(*[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns])


# A12 / A13
def aggregate_by_cluster(df: DataFrame, cluster: str, columns: Sequence[str], func: str = "avg") -> DataFrame:
    """One aggregate of each column per cluster.  Medians are read off exact
    order statistics, so no cluster's values are held in one buffer; a cluster
    without a value has a null median."""
    if func == "median":
        q = quantile_table_wide_by(exact_quantiles(df, columns, [0.5], [cluster]), cluster, columns)
        return join_null_safe(df.select(cluster).distinct(), q, [cluster], "left")
    fn = {"avg": F.avg, "mean": F.avg, "sum": F.sum, "min": F.min,
          "max": F.max, "std": F.stddev_samp, "count": F.count}[func]
    return df.groupBy(cluster).agg(*[fn(c).alias(c) for c in columns])


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    g = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    return share_of_total(g, "n", "share", 1.0, None)


# A14
def cluster_zscore_profile(df: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """Long ``(cluster, feature, mean, zscore)``: cluster means standardised
    across clusters (population std of the means; zero spread -> NULL)."""
    means = df.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in columns])
    long = means.select(cluster, F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("mean")) for c in columns])))
    w = Window.partitionBy("feature")  # rows per feature = #clusters
    sd = F.stddev_pop("mean").over(w)
    return long.withColumn("zscore", F.when(sd > 0, (F.col("mean") - F.avg("mean").over(w)) / sd))


# A15
def histogram(df: DataFrame, column: str, bins: int = 40, by: str | None = None,
              per_group_range: bool = False, density: bool = False) -> DataFrame:
    """Equal-width bins between min and max, last bin closed; optional split
    column.  ``per_group_range`` bins every group over its own min/max (one
    histogram per group, as overlaid per-outcome histograms are drawn);
    ``density`` adds count / (group rows x bin width)."""
    v = F.col(column).cast("double")
    b = F.least(F.floor((v - F.col("_lo")) / ((F.col("_hi") - F.col("_lo")) / bins)), F.lit(bins - 1))
    keys = [by] if by else []
    if by and per_group_range:
        data = df.filter(v.isNotNull() & F.col(by).isNotNull())
        rng = data.groupBy(by).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"),
                                   F.count(F.lit(1)).alias("_n"))  # one row per group
        base = join_null_safe(data, rng, [by])
    else:
        rng = df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
        base = df.filter(v.isNotNull()).crossJoin(F.broadcast(rng))  # one-row side
        if density:
            n = df.filter(v.isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
            base = join_null_safe(base, n, keys) if keys else base.crossJoin(F.broadcast(n))
    base = base.withColumn("bin", F.when(F.col("_hi") > F.col("_lo"), b).otherwise(F.lit(0)).cast("int"))
    extra = ["_n"] if density else []
    g = base.groupBy(*keys, "bin", "_lo", "_hi", *extra).agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    cols = [*keys, "bin", (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
            (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"), "count"]
    if density:
        cols.append(F.when(width > 0, F.col("count") / (F.col("_n") * width)).alias("density"))
    return g.select(*cols)


# A16
def box_stats(df: DataFrame, columns: Sequence[str], group: str | None = None) -> DataFrame:
    """Q1, median, Q3, whiskers (extreme datum inside 1.5 IQR fences), outliers."""
    keys = [group] if group else []
    cols = [c for c in columns if c in df.columns]
    long = unpivot_numeric(df, cols, keep=keys)
    if group:
        long = long.filter(F.col(group).isNotNull())
    probs = [0.25, 0.5, 0.75]
    q = quantile_table_wide(exact_quantiles(df, cols, probs, group_cols=keys, long_df=long),
                            keys + ["column"], probs, ["q1", "median", "q3"])
    q = (q.withColumn("_lf", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")))
         .withColumn("_uf", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))))
    j = join_null_safe(long, q, keys + ["column"])
    inside = (F.col("value") >= F.col("_lf")) & (F.col("value") <= F.col("_uf"))
    return (j.groupBy(*keys, "column")
            .agg(F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
                 F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
                 F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
                 F.count(F.when(~inside, 1)).alias("n_outliers"),
                 F.count(F.lit(1)).alias("n")))


# A17
def density_2d(df: DataFrame, x: str, y: str, gridsize: int = 30) -> DataFrame:
    """Square-grid 2-D counts (cells with at least one point)."""
    xv, yv = F.col(x).cast("double"), F.col(y).cast("double")
    rng = df.agg(F.min(xv).alias("_x0"), F.max(xv).alias("_x1"), F.min(yv).alias("_y0"), F.max(yv).alias("_y1"))
    def cell(v, lo, hi):
        return F.when(F.col(hi) > F.col(lo),
                      F.least(F.floor((v - F.col(lo)) / ((F.col(hi) - F.col(lo)) / gridsize)),
                              F.lit(gridsize - 1))).otherwise(F.lit(0)).cast("int")
    base = (df.filter(xv.isNotNull() & yv.isNotNull()).crossJoin(F.broadcast(rng))  # one-row side
            .select(cell(xv, "_x0", "_x1").alias("bin_x"), cell(yv, "_y0", "_y1").alias("bin_y")))
    return base.groupBy("bin_x", "bin_y").agg(F.count(F.lit(1)).alias("count"))


# A18
def kde_curve(df: DataFrame, column: str, grid_points: int = 200, bins: int = 512,
              by: str | None = None) -> DataFrame:
    """Gaussian KDE evaluated on a grid, summing kernels over histogram bins
    (bin centres weighted by counts) so work is #bins x #grid, not #rows.
    Bandwidth: Scott's rule n^(-1/5) * std."""
    keys = [by] if by else []
    v = F.col(column).cast("double")
    base = df.filter(v.isNotNull())
    if by:
        base = base.filter(F.col(by).isNotNull())
    stats = base.groupBy(*keys).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"),
                                    F.stddev_samp(v).alias("_sd"), F.count(F.lit(1)).alias("_n"))
    j = join_null_safe(base.select(*keys, v.alias("_v")), stats, keys) if keys else \
        base.select(v.alias("_v")).crossJoin(F.broadcast(stats))
    width = (F.col("_hi") - F.col("_lo")) / bins
    hb = j.withColumn("_b", F.when(F.col("_hi") > F.col("_lo"), F.least(
        F.floor((F.col("_v") - F.col("_lo")) / width), F.lit(bins - 1))).otherwise(0))
    hist = hb.groupBy(*keys, "_b", "_lo", "_hi", "_sd", "_n").agg(F.count(F.lit(1)).alias("_c"))
    hist = hist.withColumn("_x", F.col("_lo") + (F.col("_b") + 0.5) * width)
    grid = F.explode(F.sequence(F.lit(0), F.lit(grid_points - 1))).alias("gi")
    pts = hist.select(*keys, "_x", "_c", "_lo", "_hi", "_sd", "_n", grid)  # bins x grid rows
    h = F.col("_sd") * F.pow(F.col("_n"), -0.2)
    gx = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("gi") / (grid_points - 1)
    k = F.when(h > 0, F.col("_c") * F.exp(-0.5 * F.pow((gx - F.col("_x")) / h, 2))
               / (h * F.sqrt(F.lit(2 * 3.141592653589793))))  # zero spread -> no density
    return (pts.withColumn("x", gx).withColumn("_k", k)
            .groupBy(*keys, "gi", "x", "_n").agg(F.sum("_k").alias("_s"))
            .select(*keys, "gi", "x", (F.col("_s") / F.col("_n")).alias("density")))


# mode helper
def mode_table(df: DataFrame, columns: Sequence[str], group: str | None = None) -> DataFrame:
    """Most frequent non-NULL value per column (smallest value on ties)."""
    keys = [group] if group else []
    long = df.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])))
    cnt = long.filter(F.col("value").isNotNull()).groupBy(*keys, "column", "value").agg(
        F.count(F.lit(1)).alias("_n"))
    best = cnt.groupBy(*keys, "column").agg(
        F.min_by(F.col("value"), F.struct(-F.col("_n"), F.col("value"))).alias("mode"))
    return best
