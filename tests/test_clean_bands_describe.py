import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.operators import bands as B
from lendscope.operators import clean as C
from lendscope.operators import describe as A
from lendscope.operators import quality as DQ
from lendscope.operators.ordered import exact_quantiles
from lendscope.operators.policy import RiskPolicy


def test_percent_parsing(spark):
    df = spark.createDataFrame([("13.5%",), ("7.2%",), (None,), (" nan ",), ("x%",)], "int_rate string")
    out = [r[0] for r in C.clean_percentage_columns(df, ["int_rate"]).collect()]
    assert out[:2] == [13.5, 7.2] and out[2:] == [None, None, None]
    num = spark.createDataFrame([(1.5,), (float("nan"),)], "int_rate double")
    assert [r[0] for r in C.clean_percentage_columns(num, ["int_rate"]).collect()] == [1.5, None]


def test_emp_length(spark):
    df = spark.createDataFrame([("10+ years",), ("< 1 year",), ("5 years",), ("unknown",)], "emp_length string")
    assert [r[0] for r in C.parse_emp_length(df).select("emp_length_years").collect()] == [10.0, 0.0, 5.0, None]
    assert C.parse_emp_length(spark.range(2)).select("emp_length_years").distinct().collect()[0][0] is None


def test_target_and_missing_status(spark):
    df = spark.createDataFrame([(s,) for s in ["Fully Paid", "Charged Off", "Default", "Current", "Late"]],
                               "loan_status string")
    assert [r[0] for r in C.create_target_variable(df).select("default_flag").collect()] == [0, 1, 1]
    with pytest.raises(KeyError):
        C.create_target_variable(spark.range(1))


def test_state_filter_missing_column_is_noop(spark):
    df = spark.range(3)
    assert C.filter_to_target_state(df, "IN").count() == 3


def test_winsorize_k15(spark):
    df = spark.createDataFrame([(30000.0,), (40000.0,), (50000.0,), (1000000.0,)], "annual_inc double")
    out = [r[0] for r in C.winsorize_columns(df, ["annual_inc"], k=1.5).collect()]
    assert out[:3] == [30000.0, 40000.0, 50000.0] and out[3] < 1000000.0
    nulls = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert C.winsorize_columns(nulls, ["x"]).collect()[1][0] is None


def test_default_rate_by_group(spark):
    df = spark.createDataFrame([("A", 0), ("A", 0), ("A", 1), ("B", 1), ("B", 1), (None, 1)], "grade string, default_flag int")
    rows = A.default_rate_by_group(df, "grade").collect()
    assert [(r.grade, r.default_rate) for r in rows] == [("B", 1.0), ("A", 0.3333)]


def test_wilson_interval(spark):
    df = spark.createDataFrame([("g", 1 if i < 25 else 0) for i in range(100)], "g string, default_flag int")
    r = A.default_rate_ci_by_group(df, "g").first()
    assert r.ci_lower <= 0.25 <= r.ci_upper and r.default_rate == 0.25


def test_moments_and_exact_quantiles(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 2, 5, 9, 30)], "x double")
    r = A.numeric_descriptive_stats(df, ["x"], decimals=None).first()
    assert r.median == 3.5 and abs(r.skewness - 1.5327) < 1e-3 and abs(r.excess_kurtosis - 0.6961) < 1e-3


def test_exact_quantiles_match_numpy_with_hot_value(spark):
    rng = np.random.default_rng(7)
    vals = [float(v) for v in rng.lognormal(3, 1, 600)] + [42.0] * 300 + [None] * 20  # hot value: a third of rows
    df = spark.createDataFrame([(v, i % 3) for i, v in enumerate(vals)], "x double, g int")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["g"], round(r["prob"], 6)): r["value"]
           for r in exact_quantiles(df, ["x"], probs, group_cols=["g"]).collect()}
    for g in range(3):
        xs = np.array([v for i, v in enumerate(vals) if v is not None and i % 3 == g])
        for p in probs:
            assert math.isclose(got[(g, p)], float(np.quantile(xs, p)), rel_tol=1e-12)


def test_fixed_bands(spark):
    df = spark.createDataFrame([(5.0,), (12.0,), (18.0,), (25.0,), (99.0,)], "x double")
    out = [r[0] for r in B.bin_into_bands(df, "x", [0, 10, 15, 20, 30], ["low", "mid", "high", "very_high"],
                                          out="b").select("b").collect()]
    assert out == ["low", "mid", "high", "very_high", None]


def test_quantile_bins_keep_ties_together(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 1, 1, 2, 3, 4]], "x double")
    out = B.bin_into_quantiles(df, "x", 4, out="q").groupBy("x").agg(F.countDistinct("q").alias("k")).collect()
    assert all(r.k == 1 for r in out)


def test_policy_band_edges(spark):
    pol = RiskPolicy()
    df = spark.createDataFrame([(0.0,), (0.15,), (0.35,), (0.60,), (1.0,), (-0.1,)], "p double")
    tiers = [r[0] for r in df.select(pol.tier_expr(F.col("p"))).collect()]
    assert tiers == ["Low Risk", "Moderate Risk", "High Risk", "Very High Risk", "Very High Risk", "Very High Risk"]


def test_dtype_report_and_variable_descriptions(spark):
    df = spark.createDataFrame([(1.0, "A", 3)], "dti double, grade string, mystery int")
    assert {r["column"]: r["dtype"] for r in DQ.dtype_report(df).collect()} == {
        "dti": "double", "grade": "string", "mystery": "int"}
    d = {r.variable: r.description for r in DQ.variable_description_table(df).collect()}
    assert d["dti"].startswith("Debt-to-income ratio") and d["mystery"] == "See project data dictionary."


def test_importance_merge_is_full_outer(spark):
    from lendscope.operators.explain import importance_merge
    native = spark.createDataFrame([("numeric__dti", 0.3), ("onehot_categorical__term_ 36 months", 0.1)],
                                   "feature string, importance double")
    perm = spark.createDataFrame([("dti", 0.02), ("grade", 0.01)], "feature string, importance_mean double")
    rows = {r.feature: r for r in importance_merge(native, perm).collect()}
    assert rows["dti"].importance == 0.3 and rows["dti"].importance_mean == 0.02
    assert rows["grade"].importance is None and rows["onehot_categorical__term_ 36 months"].importance_mean is None


def test_duplicates_and_missing(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None)], "k int, v string")
    assert DQ.duplicate_row_count(df).first()[0] == 3
    m = {r["column"]: r["missing_count"] for r in DQ.missing_summary(df).collect()}
    assert m == {"v": 2}
