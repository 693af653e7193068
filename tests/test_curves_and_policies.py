"""ICE in closed form against copied rows; bands of many policies; one scan for many pairs."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lendscope.operators import explain as X
from lendscope.operators import hypothesis as T
from lendscope.operators import models as M
from lendscope.operators import policy as P
from lendscope.operators.fairness import fairness_report
from lendscope.plans.inputs import loans, scored
from tests.conftest import SF


def test_linear_ice_equals_copied_rows(spark):
    df = loans(spark, SF)
    model = M.make_estimator("logistic_regression", {"C": 1.0}, df.count()).fit(M.with_label(df))
    few = df.orderBy("id").limit(40).persist()
    got = {(r.id, r.grid_value): r.p for r in X.partial_dependence(model, few, "int_rate", 7, ice=True).collect()}
    grid = sorted({g for _, g in got})
    copies = few.drop("int_rate").withColumn("int_rate", F.explode(F.array(*[F.lit(g) for g in grid])))
    want = {(r.id, r.int_rate): r.p for r in model.transform(copies).select(
        "id", "int_rate", vector_to_array("probability")[1].alias("p")).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-9 for k, v in want.items())
    mean = {r.grid_value: r.mean_p for r in X.partial_dependence(model, few, "int_rate", 7).collect()}
    assert all(abs(mean[g] - sum(v for (_, h), v in want.items() if h == g) / 40) < 1e-9 for g in grid)


def test_bands_of_many_policies(spark):
    bands = spark.createDataFrame([("a", "low", 0.0, 0.5), ("a", "high", 0.5, 1.01), ("b", "x", 0.0, 0.2), ("b", "y", 0.2, 0.2),
                                   ("b", "z", 0.2, 0.9)], "policy_id string, name string, min_probability double, max_probability double")
    rows = [(1, "a", 0.5), (2, "a", 0.4999), (3, "b", 0.2), (4, "b", 0.95), (5, "b", -0.1), (6, "a", None), (7, "c", 0.1),
            (8, None, 0.1), (9, "b", float("nan")), (10, "b", 0.0)]
    out = P.policy_band_join(spark.createDataFrame(rows, "id int, policy string, p double"), "p", "policy", bands)
    assert {r.id: r.risk_tier for r in out.collect()} == {1: "high", 2: "low", 3: "z", 4: "z", 5: "z", 6: "high", 7: None,
                                                          8: None, 9: "z", 10: "x"}


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [") + plan.count("Relation[")


def test_one_evaluation_of_the_input(spark):
    book = loans(spark, SF)
    once = scans(book)
    pairs = [("int_rate", "dti"), ("loan_amnt", "installment"), ("annual_inc", "loan_amnt")]
    assert scans(T.correlation_tests(book, pairs, "pearson")) == once
    assert scans(T.correlation_matrix(book, ["int_rate", "dti", "loan_amnt"], "spearman")) <= 3 * once
    lineitem = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("l_orderkey#") > 0
    d = scored(spark, SF).withColumn("y", F.col("default_flag"))
    assert lineitem(d)
    assert not lineitem(fairness_report(d, ["grade", "purpose"]))        # every later step reads what was written
    assert not lineitem(T.chi_square_tests(book, ["grade", "purpose"]))
