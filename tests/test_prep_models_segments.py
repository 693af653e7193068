import pytest
from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators import models as M
from lendscope.operators import prep as FP
from lendscope.operators import segments as G
from lendscope.plans.inputs import loans
from tests.conftest import SF


def test_split_counts_follow_allocation(spark):
    df = loans(spark, SF)
    counts = {r[0]: r[1] for r in df.groupBy("default_flag").count().collect()}
    s = FP.stratified_split(df)
    got = {(r.split, r.default_flag): r["count"] for r in s.groupBy("split", "default_flag").count().collect()}
    q = FP.split_quotas(counts)
    for k, (t, v, tr) in q.items():
        assert got.get(("test", k), 0) == t and got.get(("val", k), 0) == v and got.get(("train", k), 0) == tr
    assert s.select("id").distinct().count() == df.count()


def test_reference_split_sizes():
    # 21,716 rows split 70/15/15 gives 15,200 / 3,258 / 3,258
    q = FP.split_quotas({0: 21716 - 4649, 1: 4649})
    assert sum(v[0] for v in q.values()) == 3258 and sum(v[1] for v in q.values()) == 3258
    assert sum(v[2] for v in q.values()) == 15200


def test_folds_are_balanced(spark):
    df = loans(spark, SF)
    f = FP.stratified_folds(df, 5).groupBy("fold", "default_flag").count().collect()
    by_class = {}
    for r in f:
        by_class.setdefault(r.default_flag, []).append(r["count"])
    for v in by_class.values():
        assert max(v) - min(v) <= 1


def test_exact_median_imputer(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 2, 5, 9, 30)] + [(None,)], "x double")
    m = FP.ExactMedianImputer(inputCols=["x"]).fit(df)
    assert m.transform(df).collect()[-1][0] == 3.5


def test_clustering_preprocessor_dims(spark):
    df = loans(spark, SF)
    out = FP.build_clustering_preprocessor().fit(df).transform(df)
    r = out.select("features").first()[0]
    assert r.size == 15
    assert out.filter(F.col("features").isNull()).count() == 0


def _planted(spark, n=600):
    u = lambda s: (F.abs(F.xxhash64("id", F.lit(s))) % 100000) / 100000.0
    base = spark.range(n).select(
        "id", (5 + u(1) * 25).alias("int_rate"), (u(2) * 40).alias("dti"), (20000 + u(3) * 100000).alias("annual_inc"),
        (1000 + u(4) * 30000).alias("loan_amnt"), (u(5) * 800).alias("installment"), F.lit(0.0).alias("delinq_2yrs"),
        (1 + F.floor(u(6) * 20)).alias("open_acc"), F.lit(0.0).alias("pub_rec"), (u(7) * 50000).alias("revol_bal"),
        (u(8) * 100).alias("revol_util"), (2 + F.floor(u(9) * 40)).alias("total_acc"), F.floor(u(10) * 5).alias("mort_acc"),
        F.lit(0.0).alias("pub_rec_bankruptcies"), F.floor(u(11) * 11).alias("emp_length_years"),
        F.when(u(12) < 0.7, " 36 months").otherwise(" 60 months").alias("term"),
        F.when(u(13) < 0.5, "RENT").otherwise("MORTGAGE").alias("home_ownership"),
        F.lit("Verified").alias("verification_status"), F.lit("debt_consolidation").alias("purpose"),
        F.lit("w").alias("initial_list_status"), F.lit("Individual").alias("application_type"),
        F.element_at(F.array(*[F.lit(g) for g in "ABCDEFG"]), (1 + F.floor(u(14) * 7)).cast("int")).alias("grade"),
        u(15).alias("_u"))
    logit = -3 + 0.12 * (F.col("int_rate") - 13) + 0.05 * (F.col("dti") - 18) - 0.00003 * (F.col("annual_inc") - 60000)
    return base.withColumn("default_flag", (F.col("_u") < 1 / (1 + F.exp(-logit))).cast("int"))


def test_planted_signal_model(spark):
    df = FP.stratified_split(_planted(spark), test_size=0.2, validation_size=0.2)
    tr = M.with_label(df.filter(F.col("split") == "train"))
    model = M.make_estimator("logistic_regression", {"C": 1.0, "penalty": "l2"}, tr.count()).fit(tr)
    sc = M.predict_probability(model, df).select("split", F.col("default_flag").alias("y"), "p")
    auc = {r.split: r.roc_auc for r in M.evaluate_splits(sc).collect()}
    assert auc["test"] > 0.65
    from lendscope.operators.explain import coefficient_table
    top = [r.feature for r in coefficient_table(model).limit(3).collect()]
    assert "numeric__int_rate" in top
    assert M.predict_probability(model, df.limit(0)).count() == 0


def test_resolve_production_model_key(spark):
    t = spark.createDataFrame([("logistic_regression", "0.70"), ("random_forest", "0.72"), ("xgboost", "0.72")],
                              "model string, roc_auc string")
    assert M.resolve_production_model_key(t) == "random_forest"
    e = spark.createDataFrame([("foo", "nan")], "model string, roc_auc string")
    assert M.resolve_production_model_key(e, "xgboost") == "xgboost"
    with pytest.raises(ValueError):
        M.make_classifier("unknown", {}, 10)


def test_planted_segments_named(spark):
    rows = []
    for i in range(60):
        rows.append((0, 90000.0, 8.0, 7.0, 10.0, 20.0, 1 if i < 5 else 0))
        rows.append((1, 30000.0, 35.0, 25.0, 2.0, 80.0, 1 if i < 50 else 0))
    df = spark.createDataFrame(rows, "cluster int, annual_inc double, dti double, int_rate double, "
                                     "emp_length_years double, revol_util double, default_flag int")
    prof = G.cluster_profile(df)
    names = {r.cluster_id: r.segment_name for r in G.assign_segment_names(prof).collect()}
    assert names[1] == "High Risk Borrowers" and names[0] == "Prime Borrowers"


def test_random_search_draws_and_cv(spark):
    d1 = M.random_draws(M.FOREST_SPACE, 5, seed=7)
    assert d1 == M.random_draws(M.FOREST_SPACE, 5, seed=7)
    assert all(set(d) == set(M.FOREST_SPACE) and all(d[k] in M.FOREST_SPACE[k] for k in d) for d in d1)
    df = FP.stratified_folds(_planted(spark, 300), 3)
    out = M.tune_model(df, "logistic_regression", candidates=[{"C": 0.01, "penalty": "l2"}, {"C": 1.0, "penalty": "l1"}])
    assert out["summary"].count() == 2 and out["folds"].count() == 3
    assert out["best_params"] in out["candidates"]


def test_assign_nearest_ties_to_lowest(spark):
    df = spark.createDataFrame([([0.5, 0.0],), ([2.0, 0.0],)], "v array<double>")
    out = [r.c for r in G.assign_nearest(df, F.col("v"), {0: [0.0, 0.0], 1: [1.0, 0.0], 2: [2.0, 0.0]}, "c").collect()]
    assert out == [0, 2]
