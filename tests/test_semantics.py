"""Constant inputs, rounding of exact binary values, lookups and model names."""

import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lendscope.operators import hypothesis as T
from lendscope.operators import models as M
from lendscope.operators import policy as P
from lendscope.operators import segments as G


@pytest.fixture(scope="module")
def flat(spark):
    rows = [(float(i % 7), 3.0, float((i * i) % 11), i % 2, "g%d" % (i % 3)) for i in range(60)]
    return spark.createDataFrame(rows, "a double, k double, b double, default_flag int, g string")


def test_correlations_with_a_constant_side_are_null(flat):
    a = np.array([i % 7 for i in range(60)], float)
    b = np.array([(i * i) % 11 for i in range(60)], float)
    for method in ("pearson", "spearman"):
        got = {r.var_b: r.statistic for r in T.correlation_tests(flat, [("a", "k"), ("a", "b")], method).collect()}
        if method == "spearman":
            rank = lambda x: np.array([(x < v).sum() + ((x == v).sum() + 1) / 2 for v in x])
            want = np.corrcoef(rank(a), rank(b))[0, 1]
        else:
            want = np.corrcoef(a, b)[0, 1]
        assert got["k"] is None and math.isclose(got["b"], want, rel_tol=1e-9)
    m = {(r.var_a, r.var_b): r.r for r in T.correlation_matrix(flat, ["a", "k", "b"]).collect()}
    assert m[("a", "k")] is None and m[("k", "b")] is None and m[("a", "b")] is not None
    assert {r.variable for r in T.target_correlation_ranking(flat, ["a", "k", "b"]).collect()} == {"a", "b"}
    vif = {r.variable: r.vif for r in T.variance_inflation_factors(flat, ["a", "k", "b"]).collect()}
    assert vif["k"] is None and math.isclose(vif["a"], vif["b"], rel_tol=1e-9) and vif["a"] >= 1
    score = {(r.var_a, r.var_b): r.r for r in T.score_correlations(flat, ["a", "k"]).collect()}
    assert score[("a", "k")] is None
    means = flat.select(F.lit("m").alias("model"), F.lit(0.5).alias("mean_p"), F.col("a").alias("default_rate"))
    assert G.probability_rate_correlation(means).first().corr_with_default_rate is None


def test_anova_without_spread_has_no_statistic(spark, flat):
    got = {r.var_a: r for r in T.anova_tests(flat, ["k", "a"], "g").collect()}
    assert got["k"].statistic is None and got["a"].statistic is not None
    steps = spark.createDataFrame([(float(i % 3), "g%d" % (i % 3)) for i in range(30)], "x double, g string")
    assert T.anova_tests(steps, ["x"], "g").first().statistic is None


def test_tenths_follow_the_exact_binary_value(spark):
    values = [i / 10000 * 100 for i in range(10001)] + [12.35, 0.25, 0.75, 2.5, 0.05, 99.95, 0.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    out = df.select("x", P.round_tenth(F.col("x")).alias("r")).collect()
    assert all(r.r == round(r.x, 1) for r in out if r.x is not None)
    assert [r.r for r in out if r.x is None] == [None]


def test_unknown_tier_raises_and_null_stays_null(spark):
    pol = P.RiskPolicy()
    known = pol.risk_tiers[0][0]
    df = spark.createDataFrame([(known,), (None,)], "t string")
    assert [r.a is None for r in df.select(pol.action_expr(F.col("t")).alias("a")).collect()] == [False, True]
    with pytest.raises(PySparkException):
        spark.createDataFrame([("no such tier",)], "t string").select(pol.rate_expr(F.col("t"))).collect()


def test_production_model_key(spark):
    table = lambda rows: spark.createDataFrame(rows, "model string, roc_auc string").coalesce(1)
    key = M.resolve_production_model_key
    assert key(table([("Random Forest", "0.705642"), ("Logistic Regression", "0.705998"), ("XGBoost", "0.706285")])) == "gradient_boosting"
    assert key(table([("Random Forest", "0.8")])) == "random_forest"
    assert key(table([("Logistic Regression", "0.8")])) == "logistic_regression"
    assert key(table([("XGBoost", "0.8"), ("Random Forest", "not-a-number")])) == "gradient_boosting"
    assert key(table([("Some Future Model", "0.9")])) == "gradient_boosting"
    assert key(spark.createDataFrame([("Random Forest",)], "model string")) == "gradient_boosting"
    assert key(table([]), "random_forest") == key(None, "random_forest") == "random_forest"


def test_boosting_search_has_the_class_ratio_axis(spark):
    df = spark.createDataFrame([(int(i % 4 == 0),) for i in range(40)], "default_flag int")
    assert M.boost_space(df)["scale_pos_weight"] == [1.0, 3.0]
    assert M.weight_mode({"scale_pos_weight": 3.0}) == "scale_pos" and M.weight_mode({"class_weight": "balanced"}) == "balanced"
    assert M.weight_mode({"scale_pos_weight": 1.0}) is None
    assert M.forest_classifier(max_depth=None).getMaxDepth() == 30
    assert M.forest_classifier(min_samples_split=20, min_samples_leaf=4).getMinInstancesPerNode() == 10


def test_plans_join_no_rows_without_a_key(spark):
    import __spark_entry__ as E
    for name in ("e9_roc_pr_points", "t6_spearman"):
        plan = E.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
