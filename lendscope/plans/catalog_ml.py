"""Registered queries for prep/split, models, segmentation, attribution and
streaming.  Model fits and randomised operators are checked rows-only
(no SQL oracle); per-cluster and score-based tables have oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators import evaluate as E
from lendscope.operators import explain as X
from lendscope.operators import hypothesis as T
from lendscope.operators import models as M
from lendscope.operators import policy as P
from lendscope.operators import prep as FP
from lendscope.operators import quality as DQ
from lendscope.operators import segments as G
from lendscope.operators.describe import order_index
from lendscope.operators.ordered import exact_quantiles, quantile_table_wide
from lendscope.plans.catalog import register
from lendscope.plans.inputs import kept_loans, loans, rounded, scored, sig_round
from lendscope.session import checkpoint_dir, right_size, written
from lendscope.sources.tables import loan_book, read_table, scored_loans


def split_loans(spark, sf):
    """Cleaned loans with split and fold ids, written once: the fits, transforms
    and evaluations of one query all read it."""
    return written(FP.stratified_folds(split_only(spark, sf), R.CV_FOLDS), "folds")


def split_only(spark, sf):
    """Cleaned loans, written once, with the train/val/test split (no CV folds)."""
    return FP.stratified_split(kept_loans(spark, sf))


# ------------------------------------------------------------------ prep
@register("f9_stratified_split_counts")
def q_f9(spark, sf):
    s = FP.stratified_split(loans(spark, sf))
    return s.groupBy("split", R.TARGET_COLUMN).agg(F.count(F.lit(1)).alias("n"))


@register("f10_stratified_fold_counts")
def q_f10(spark, sf):
    s = FP.stratified_folds(loans(spark, sf), R.CV_FOLDS)
    return s.groupBy("fold", R.TARGET_COLUMN).agg(F.count(F.lit(1)).alias("n"))


@register("f6_preprocessed_features")
def q_f6(spark, sf):
    df = split_only(spark, sf)
    prep = FP.build_preprocessing_pipeline().fit(df.filter(F.col("split") == "train"))
    out = prep.transform(df)
    names = FP.feature_names(prep)
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array("features")
    return out.select("id", "split", *[arr[i].alias(f"f{i}") for i in range(len(names))])


def _long_features(model, df, names):
    """(id, feature, value) for every slot of the assembled vector."""
    from pyspark.ml.functions import vector_to_array
    names_arr = F.array(*[F.lit(n) for n in names])  # #features literals
    out = model.transform(df).select("id", F.inline(F.arrays_zip(names_arr.alias("feature"),
                                                                  vector_to_array("features").alias("value"))))
    return rounded(out)


@register("f6_preprocessing_fit_all")
def q_f6_all(spark, sf):
    """Model preprocessing (exact median impute + population scaling, mode
    impute + alphabetical one-hot, ordinal grade) fitted on the whole table."""
    df = loans(spark, sf)
    prep = FP.build_preprocessing_pipeline().fit(df)
    return _long_features(prep, df, FP.feature_names(prep))


@register("f8_clustering_features")
def q_f8(spark, sf):
    """Clustering preprocessing (15 dims: scaled numerics + scaled grade)."""
    df = loans(spark, sf)
    prep = FP.build_clustering_preprocessor().fit(df)
    return _long_features(prep, df, FP.feature_names(prep))


@register("m6_class_weights")
def q_m6(spark, sf):
    return FP.class_weights(loans(spark, sf)).groupBy(R.TARGET_COLUMN, "weight").count()


# ------------------------------------------------------------------ models
def _fit_eval(df, key, params):
    """(model fitted on the training rows, scores of every row) of loans with a split."""
    tr = M.with_label(df.filter(F.col("split") == "train"))
    if params.get("class_weight"):
        tr = FP.class_weights(tr)
    n = tr.count()
    model = M.make_estimator(key, params, n).fit(right_size(tr, n))
    # scored once: the per-split metric jobs (counts, ranks, calibration) all read it
    sc = M.predict_probability(model, df).select("id", "split", F.col(R.TARGET_COLUMN).alias("y"), "p").persist()
    return model, sc


@register("m1_logistic_regression_fit")
def q_m1(spark, sf):
    df = split_only(spark, sf)
    _, sc = _fit_eval(df, "logistic_regression", {"C": 1.0, "penalty": "l2"})
    return M.evaluate_splits(sc)


@register("m2_random_forest_fit")
def q_m2(spark, sf):
    df = split_only(spark, sf)
    _, sc = _fit_eval(df, "random_forest", {"n_estimators": 200, "max_depth": 8, "min_samples_leaf": 2})
    return M.evaluate_splits(sc)


@register("m3_gradient_boosting_fit")
def q_m3(spark, sf):
    df = split_only(spark, sf)
    _, sc = _fit_eval(df, "gradient_boosting", {"n_estimators": 150, "max_depth": 4, "learning_rate": 0.1})
    return M.evaluate_splits(sc)


@register("m4_logistic_grid_search_cv")
def q_m4(spark, sf):
    train = split_loans(spark, sf).filter(F.col("split") == "train")
    t = M.tune_model(train, "logistic_regression")
    cands = spark.createDataFrame([(i, str(c)) for i, c in enumerate(t["candidates"])], "candidate int, params string")
    return t["summary"].join(cands, "candidate")


@register("m8_cv_fold_table")
def q_m8(spark, sf):
    train = split_loans(spark, sf).filter(F.col("split") == "train")
    folds, _ = M.cross_validate(train, "logistic_regression", [{"C": 1.0, "penalty": "l2"}])
    return folds


@register("m9_platt_calibration")
def q_m9(spark, sf):
    df = split_only(spark, sf)
    model, _ = _fit_eval(df, "logistic_regression", {"C": 1.0, "penalty": "l2"})
    s = M.raw_score(model, M.with_label(df), "logistic_regression") \
        .withColumn("y", F.col(M.LABEL).cast("int"))
    a, b = M.platt_calibrator(s.filter(F.col("split") == "val"))
    return M.evaluate_splits(M.apply_platt(s, a, b).select("split", "y", "p"))


@register("m9_isotonic_calibration")
def q_m9i(spark, sf):
    df = split_only(spark, sf)
    model, _ = _fit_eval(df, "random_forest", {"n_estimators": 100, "max_depth": 6})
    s = M.raw_score(model, M.with_label(df), "random_forest") \
        .withColumn("y", F.col(M.LABEL).cast("int"))
    iso = M.isotonic_calibrator(s.filter(F.col("split") == "val"))
    return M.evaluate_splits(s.withColumn("p", iso.apply(F.col("raw_score"))).select("split", "y", "p"))


@register("m9_isotonic_fit")
def q_m9_fit(spark, sf):
    """The isotonic curve of the stand-in score, in steps of 1/200, at every score."""
    d = scored(spark, sf).select(F.col(R.TARGET_COLUMN).alias("y"), (F.floor(F.col("p") * 200) / 200.0).alias("s"))
    curve = M.isotonic_calibrator(d, "s")
    per = d.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    return rounded(per.select("s", "n", curve.apply(F.col("s")).alias("calibrated")))


#: Candidates of the ensembles in the registered comparison and training job.
STAGED = {"random_forest": [{"n_estimators": n, "max_depth": 6, "min_samples_leaf": 4} for n in (10, 25, 50)],
          "gradient_boosting": [{"n_estimators": n, "max_depth": 4, "learning_rate": 0.1} for n in (10, 25, 50)]}
#: Candidates of the registered training job, a subset of the spaces (m4 runs the whole logistic grid).
JOB = {"logistic_regression": [{"C": c, "penalty": "l2"} for c in (0.1, 1.0, 10.0)],
       "random_forest": [{"n_estimators": n, "max_depth": 5, "min_samples_leaf": 4} for n in (10, 20)],
       "gradient_boosting": [{"n_estimators": n, "max_depth": 3, "learning_rate": 0.1} for n in (10, 20)]}


@register("m12_model_comparison")
def q_m12(spark, sf):
    df = split_loans(spark, sf)
    # one logistic candidate (m4 runs the grid), prefixes of one ensemble fit per fold for the others
    cands = {"logistic_regression": [{"C": 1.0, "penalty": "l2"}], **STAGED}
    return M.comparison_table(M.train_all(df, list(cands), cands))


@register("m14_learning_curve")
def q_m14(spark, sf):
    train = split_loans(spark, sf).filter(F.col("split") == "train")
    return M.learning_curve(train, "logistic_regression", {"C": 1.0, "penalty": "l2"})


@register("m15_validation_curve")
def q_m15(spark, sf):
    train = split_loans(spark, sf).filter(F.col("split") == "train")
    return M.validation_curve(train, "logistic_regression", {"penalty": "l2"}, "C", [0.01, 0.1, 1.0, 10.0])


@register("m16_robustness_table")
def q_m16(spark, sf):
    df = split_only(spark, sf)
    _, sc = _fit_eval(df, "logistic_regression", {"C": 1.0, "penalty": "l2"})
    return M.robustness_table(M.evaluate_splits(sc))


@register("m16_robustness_given_scores")
def q_m16g(spark, sf):
    """The stand-in score's exact AUC on three thirds of the loans, side by side."""
    d = scored(spark, sf).select(F.col(R.TARGET_COLUMN).alias("y"), "p", F.element_at(
        F.array(F.lit("train"), F.lit("val"), F.lit("test")), (F.col("id") % 3 + 1).cast("int")).alias("split"))
    return rounded(M.robustness_table(E.rank_metrics(d, "y", "p", ["split"])))


@register("p1_predict_probability")
def q_p1(spark, sf):
    df = split_only(spark, sf)
    _, sc = _fit_eval(df, "logistic_regression", {"C": 1.0, "penalty": "l2"})
    return sc


# ------------------------------------------------------------------ segmentation
def _cluster_features(spark, sf):
    df = kept_loans(spark, sf)
    prep = FP.build_clustering_preprocessor().fit(df)
    return prep.transform(df).withColumnRenamed("id", "row_id").persist()


@register("g1_kmeans_segments")
def q_g1(spark, sf):
    feats = _cluster_features(spark, sf).persist()
    m, _ = G.fit_kmeans(feats, 4)
    lab = m.transform(feats).persist()  # read by the profile, mode and share jobs
    prof = G.cluster_profile(lab)
    names = G.assign_segment_names(prof)
    tiers = G.risk_tier_lookup(None, prof)
    return G.segment_description(G.segment_comparison_table(prof, names, tiers))


@register("g2_hierarchical_segments")
def q_g2(spark, sf):
    feats = _cluster_features(spark, sf)
    lab, _ = G.fit_hierarchical(feats, 4)
    return G.cluster_profile(lab)


@register("g3_gmm_segments")
def q_g3(spark, sf):
    feats = _cluster_features(spark, sf)
    m = G.fit_gmm(feats, 4)
    return G.cluster_profile(m.transform(feats))


@register("g5_pca_view")
def q_g5(spark, sf):
    _, coords, _ = G.pca_coordinates(_cluster_features(spark, sf))
    return coords.select("row_id", "pc1", "pc2")


def _emb_long(spark, sf):
    e = read_table(spark, sf, "embeddings")
    return G.to_long(e.withColumnRenamed("vec_id", "row_id"), "embedding", "label", "row_id", is_vector=False)


@register("g7_calinski_harabasz")
def q_g7(spark, sf):
    return rounded(G.calinski_harabasz(_emb_long(spark, sf)))


@register("g8_davies_bouldin")
def q_g8(spark, sf):
    return rounded(G.davies_bouldin(_emb_long(spark, sf)))


@register("g9_evaluate_clustering")
def q_g9(spark, sf):
    e = read_table(spark, sf, "embeddings")
    from pyspark.ml.functions import array_to_vector
    v = e.select(F.col("vec_id").alias("row_id"), F.col("label").alias("cluster"),
                 array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return G.evaluate_clustering(v)


@register("g10_optimal_k_sweep")
def q_g10(spark, sf):
    feats = _cluster_features(spark, sf).persist()
    return G.evaluate_optimal_k(feats, R.K_CANDIDATES)


@register("g11_recommend_k")
def q_g11(spark, sf):
    return G.recommend_optimal_k(q_g10(spark, sf))


@register("g15_assign_nearest_centroid")
def q_g15(spark, sf):
    long = _emb_long(spark, sf)
    cents = {r["cluster"]: r["center"] for r in G.centroids(long).collect()}  # #clusters rows
    e = read_table(spark, sf, "embeddings")
    return G.assign_nearest(e, F.col("embedding").cast("array<double>"), cents, "assigned").select(
        "vec_id", "label", "assigned")


@register("g16_centroids")
def q_g16(spark, sf):
    return rounded(G.centroids_long(_emb_long(spark, sf)).select("cluster", F.col("pos").alias("dim"),
                                                                   F.col("c").alias("center")))


def _grade_segments(spark, sf):
    """Stand-in segmentation for the oracle-checked profile operators: the
    loan's grade position as its cluster id."""
    return scored(spark, sf).withColumn("cluster", order_index(F.col("grade"), R.GRADE_ORDER).cast("int"))


@register("g17_cluster_profile")
def q_g17(spark, sf):
    return rounded(G.cluster_profile(_grade_segments(spark, sf)))


@register("g18_segment_names")
def q_g18(spark, sf):
    return G.assign_segment_names(G.cluster_profile(_grade_segments(spark, sf)))


@register("g20_segment_actions")
def q_g20(spark, sf):
    prof = G.cluster_profile(_grade_segments(spark, sf))
    return rounded(G.segment_actions(G.risk_tier_lookup(None, prof)))


@register("g23_compare_with_supervised")
def q_g23(spark, sf):
    d = _grade_segments(spark, sf)
    mp = d.groupBy(F.col("cluster").alias("cluster_id")).agg(F.avg("p").alias("mean_predicted_probability"))
    prof = G.cluster_profile(d)
    tiers = G.risk_tier_lookup(mp, prof)
    comp = G.segment_comparison_table(prof, G.assign_segment_names(prof), tiers)
    return rounded(G.compare_with_supervised(d, comp))


@register("g24_probability_by_cluster")
def q_g24(spark, sf):
    d = _grade_segments(spark, sf)
    a = d.select("cluster", F.lit("score_a").alias("model"), "p", R.TARGET_COLUMN)
    b = d.select("cluster", F.lit("score_b").alias("model"),
                 (((F.col("id") * 16807) % 1000) / 1000.0 * 0.5 + F.col(R.TARGET_COLUMN) * 0.3).alias("p"),
                 R.TARGET_COLUMN)
    return rounded(G.probability_by_cluster(a.unionByName(b)))


def _grade_comparison(spark, sf):
    prof = G.cluster_profile(_grade_segments(spark, sf))
    return G.segment_comparison_table(prof, G.assign_segment_names(prof), G.risk_tier_lookup(None, prof))


@register("g21_segment_comparison")
def q_g21(spark, sf):
    return rounded(_grade_comparison(spark, sf))


@register("g22_riskiest_and_safest")
def q_g22(spark, sf):
    return G.riskiest_and_safest(_grade_comparison(spark, sf))


@register("g24_probability_rate_correlation")
def q_g24c(spark, sf):
    return rounded(G.probability_rate_correlation(q_g24(spark, sf)))


@register("g11_recommend_k_given_table")
def q_g11t(spark, sf):
    """The ranking rule on a table of three indices per candidate k: averages
    by loan grade stand in for a sweep's indices."""
    d = scored(spark, sf).withColumn("k", (order_index(F.col("grade"), R.GRADE_ORDER) + 2).cast("int"))
    table = d.groupBy("k").agg(F.avg("p").alias("silhouette"), F.avg("loan_amnt").alias("calinski_harabasz"),
                               F.avg("dti").alias("davies_bouldin"))
    return G.recommend_optimal_k(table)


@register("g2_average_linkage")
def q_g2a(spark, sf):
    """Average linkage over micro-clusters: size and mean rate of each segment."""
    lab, _ = G.fit_hierarchical(_cluster_features(spark, sf), 4, linkage="average")
    return G.cluster_profile(lab)


@register("g2_complete_linkage")
def q_g2c(spark, sf):
    lab, _ = G.fit_hierarchical(_cluster_features(spark, sf), 4, linkage="complete")
    return G.cluster_profile(lab)


@register("g4_density_clusters")
def q_g4(spark, sf):
    """Density clusters of the embeddings: cluster, noise (-1) and core flag of every row."""
    from lendscope.operators.density import density_clusters
    e = read_table(spark, sf, "embeddings")
    return density_clusters(e, 1.15, 4, "embedding", "vec_id", is_vector=False).select("vec_id", "cluster", "is_core")


@register("g4_density_segments")
def q_g4s(spark, sf):
    """Profiles of the density clusters of the loans' clustering features."""
    from lendscope.operators.density import density_clusters
    return G.cluster_profile(density_clusters(_cluster_features(spark, sf), 2.0, 10))


@register("g3_soft_membership")
def q_g3s(spark, sf):
    """Every loan's membership in each of four Gaussian components."""
    from pyspark.ml.functions import vector_to_array
    feats = _cluster_features(spark, sf)
    out = G.fit_gmm(feats, 4).transform(feats)
    return out.select("row_id", "cluster", F.posexplode(vector_to_array("membership")).alias("component", "membership"))


# ------------------------------------------------------------------ attribution
@register("x1_logistic_coefficients")
def q_x1(spark, sf):
    df = split_only(spark, sf)
    model, _ = _fit_eval(df, "logistic_regression", {"C": 1.0, "penalty": "l2"})
    return X.coefficient_table(model)


@register("x2_forest_importance")
def q_x2(spark, sf):
    df = split_only(spark, sf)
    model, _ = _fit_eval(df, "random_forest", {"n_estimators": 100, "max_depth": 8})
    return X.impurity_importance(model)


@register("x4_permutation_importance")
def q_x4(spark, sf):
    df = split_only(spark, sf)
    model, _ = _fit_eval(df, "logistic_regression", {"C": 1.0, "penalty": "l2"})
    test = df.filter(F.col("split") == "test")
    return X.permutation_importance(model, test, R.LOAN_ROLES.features, repeats=10)


def _linear(spark, sf, df=None):
    df = split_only(spark, sf) if df is None else df
    model, _ = _fit_eval(df, "logistic_regression", {"C": 1.0, "penalty": "l2"})
    bg = df.filter(F.col("split") == "train")
    return model, X.linear_attribution(model, df.filter(F.col("split") == "test"), bg)


@register("x5_linear_attribution")
def q_x5(spark, sf):
    _, (contrib, _) = _linear(spark, sf)
    return contrib


@register("x7_local_explanations")
def q_x7(spark, sf):
    _, (contrib, _) = _linear(spark, sf)
    return X.local_explanations(contrib)


@register("x8_global_importance")
def q_x8(spark, sf):
    model, (contrib, _) = _linear(spark, sf)
    return X.global_importance(contrib, X.coefficient_table(model).select("feature", "coefficient"))


@register("x9_global_direction")
def q_x9(spark, sf):
    _, (contrib, _) = _linear(spark, sf)
    return X.global_direction(X.global_importance(contrib))


@register("x11_decision_paths")
def q_x11(spark, sf):
    _, (contrib, base) = _linear(spark, sf)
    return X.decision_paths(contrib, X.global_importance(contrib), base)


@register("x13_interaction_table")
def q_x13(spark, sf):
    d = scored(spark, sf)
    a = X.interaction_table(d, "purpose", "grade")
    b = X.interaction_table(d, "home_ownership", "dti", numeric=["dti"])
    return rounded(a.unionByName(b))


@register("x13_default_interaction_pairs")
def q_x13d(spark, sf):
    """Mean score for the five default feature pairs; numeric sides in quartiles."""
    d = scored_loans(kept_loans(spark, sf))
    parts = [X.interaction_table(d, a, b, numeric=X.INTERACTION_NUMERIC) for a, b in X.DEFAULT_INTERACTION_PAIRS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rounded(out)


@register("x14_partial_dependence")
def q_x14(spark, sf):
    df = split_only(spark, sf)
    model, _ = _fit_eval(df, "logistic_regression", {"C": 1.0, "penalty": "l2"})
    test = df.filter(F.col("split") == "test")
    return X.partial_dependence(model, test, "int_rate", 100)


@register("x14_ice_curves")
def q_x14_ice(spark, sf):
    """ICE of the interest rate for every test loan under the fitted model."""
    df = split_only(spark, sf)
    model, _ = _fit_eval(df, "logistic_regression", {"C": 1.0, "penalty": "l2"})
    test = df.filter(F.col("split") == "test")
    return X.partial_dependence(model, test, "int_rate", 100, ice=True)


@register("x14_ice_given_model")
def q_x14_given(spark, sf):
    """ICE of the interest rate for every loan under a linear model with given
    coefficients."""
    d = loans(spark, sf).filter("int_rate is not null and dti is not null")
    margin = F.lit(-2.0) + F.col("int_rate") * 0.09 + F.col("dti") * 0.02
    return rounded(X.linear_curves(d, margin, F.col("int_rate"), 0.09, [(v, v) for v in (2.0, 5.0, 8.0, 11.0)]))


@register("b3_policy_per_grade")
def q_b3_policies(spark, sf):
    """A policy per loan grade, its tiers cut at the grade's score quartiles,
    written as JSON, read back, and every loan's tier under its own policy."""
    d = scored(spark, sf)
    q = quantile_table_wide(exact_quantiles(d, ["p"], [0.25, 0.5, 0.75], ["grade"]), ["grade"], [0.25, 0.5, 0.75], ["a", "b", "c"])
    tier = lambda n, lo, hi: F.struct(F.lit(n).alias("name"), lo.cast("double").alias("min_probability"),
                                      hi.cast("double").alias("max_probability"))
    names = ["t1", "t2", "t3", "t4"]
    docs = q.select(F.col("grade").alias("policy_id"), F.to_json(F.struct(
        F.array(tier("t1", F.lit(0.0), F.col("a")), tier("t2", F.col("a"), F.col("b")), tier("t3", F.col("b"), F.col("c")),
                tier("t4", F.col("c"), F.lit(1.01))).alias("risk_tiers"),
        F.array(*[F.struct(F.lit(n).alias("tier"), F.lit("review").alias("action")) for n in names]).alias("lending_actions"),
        F.struct(*[F.lit(0.0).alias(n) for n in names]).alias("interest_rate_adjustment_bps"),
        F.array(F.struct(F.lit("A").alias("grade"), F.lit(0.0).alias("min_probability"),
                         F.lit(1.01).alias("max_probability"))).alias("loan_grade_bands"))).alias("value"))
    path = _folder(spark, "policies")
    docs.repartition("policy_id").write.partitionBy("policy_id").text(path)
    tables = P.read_policy_tables(spark, path, "policy_id")
    return P.policy_band_join(d, "p", "grade", tables["risk_tiers"]).select("id", "grade", "risk_tier")


@register("p12_borrower_sentences")
def q_p12(spark, sf):
    df = split_only(spark, sf)
    model, (contrib, _) = _linear(spark, sf, df)
    loc = X.local_explanations(contrib)
    test = df.filter(F.col("split") == "test")
    sc = P.score_loans(M.predict_probability(model, test), threshold=0.5)
    j = sc.join(loc.withColumnRenamed("row_id", "id"), "id", "left")
    emp = F.array().cast("array<string>")
    return j.select("id", P.borrower_sentence(F.col("risk_tier"), F.col("default_probability"),
                                              F.coalesce("risk_factors", emp), F.coalesce("protective_factors", emp),
                                              F.col("lending_action")).alias("sentence"))


# ------------------------------------------------------------------ streaming / IO
@register("s1_streaming_policy_scoring")
def q_s1(spark, sf):
    """Raw loans are written to the shared checkpoint folder as a file source,
    streamed through cleaning + stand-in score + policy scoring, and the sink
    is read back."""
    from lendscope.streaming.scoring import score_stream
    root = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    raw = loan_book(spark, sf)
    raw.write.mode("overwrite").parquet(f"{root}/src")
    score = lambda d: d.withColumn("p", ((F.col("id") * 48271) % 1000) / 1000.0 * 0.6 + F.col("default_flag") * 0.2)
    score_stream(spark, f"{root}/src", raw.schema, f"{root}/sink", score, name=f"s1-{uuid.uuid4().hex}")
    return rounded(spark.read.parquet(f"{root}/sink"))


@register("x3_split_statistics")
def q_x3(spark, sf):
    from lendscope.operators.trees import split_statistics
    df = split_only(spark, sf)
    model, _ = _fit_eval(df, "gradient_boosting", {"n_estimators": 50, "max_depth": 4, "learning_rate": 0.1})
    return split_statistics(model.stages[-1], FP.feature_names(model), spark)


@register("x6_tree_attribution")
def q_x6(spark, sf):
    """Boosted-tree attributions for every test row (margin space)."""
    from lendscope.operators.trees import tree_attribution
    df = split_only(spark, sf)
    model, _ = _fit_eval(df, "gradient_boosting", {"n_estimators": 50, "max_depth": 4, "learning_rate": 0.1})
    test = df.filter(F.col("split") == "test")
    contrib, _ = tree_attribution(model, test, FP.feature_names(model))
    return contrib


@register("t9_variance_inflation")
def q_t9(spark, sf):
    from lendscope.operators.hypothesis import variance_inflation_factors
    return variance_inflation_factors(loans(spark, sf), R.NUMERIC_FEATURES)


@register("t12_score_correlations")
def q_t12(spark, sf):
    from lendscope.operators.hypothesis import score_correlations
    d = _grade_segments(spark, sf).select(
        "cluster", R.TARGET_COLUMN, F.col("p").alias("score_a"),
        (((F.col("id") * 16807) % 1000) / 1000.0 * 0.5 + F.col(R.TARGET_COLUMN) * 0.3).alias("score_b"))
    return rounded(score_correlations(d, ["score_a", "score_b"], cluster="cluster"))


@register("g13_segmentation_engine")
def q_g13(spark, sf):
    from lendscope.plans.segmentation import SegmentationEngine
    df = kept_loans(spark, sf)
    eng = SegmentationEngine(auto_select_k=True).fit(df)
    return eng.assign_segment(df).select("id", "cluster_id", "segment_name")


@register("g14_restored_predict_cluster")
def q_g14(spark, sf):
    """Clusters of every loan by an engine that was fitted, saved and restored."""
    from lendscope.plans.segmentation import SegmentationEngine
    df = kept_loans(spark, sf)
    root = _folder(spark, "segments")
    SegmentationEngine(n_clusters=4).fit(df).save(root)
    return SegmentationEngine.load(spark, root).predict_cluster(df).select("id", "cluster")


@register("io7_restored_assignment")
def q_io7(spark, sf):
    """Grades as given segments: the engine is saved, restored, and assigns
    every loan to the nearest of its centroids."""
    from lendscope.plans.segmentation import SegmentationEngine
    df = loans(spark, sf).withColumn("given", order_index(F.col("grade"), R.GRADE_ORDER).cast("int")).persist()
    root = _folder(spark, "segments")
    SegmentationEngine().fit_labelled(df, "given").save(root)
    return SegmentationEngine.load(spark, root).assign_segment(df).select("id", "cluster_id")


@register("io6_training_artifacts")
def q_io6(spark, sf):
    """Threshold tables of two scores published as a version, a second version
    that fails half-way, and one model's rows read back from the latest."""
    from lendscope.sources.artifacts import ArtifactStore
    d = written(scored(spark, sf).select(F.col(R.TARGET_COLUMN).alias("y"), "p"), "scores")
    half = d.withColumn("p", F.col("p") / 2)
    long = d.withColumn("model", F.lit("whole")).unionByName(half.withColumn("model", F.lit("half")))
    store = ArtifactStore(spark, _folder(spark, "artifacts"))
    with store.draft() as v:
        v.table("thresholds", E.threshold_metrics_table(long, "y", "p", keys=["model"]))
        v.notes = {"models": ["whole", "half"]}
    try:
        with store.draft() as v:
            v.table("thresholds", long.limit(1))
            raise RuntimeError("a writer that dies before its version is published")
    except RuntimeError:
        pass
    return rounded(store.latest().table("thresholds", "whole").drop("model"))


@register("io8_explainability_artifacts")
def q_io8(spark, sf):
    """Attributions, importances, directions, impurity next to permutation
    importance (X10), fairness and interactions published as a version; the
    importance table is read back."""
    from lendscope.plans.explainability import write_explainability
    from lendscope.sources.artifacts import ArtifactStore
    root = _folder(spark, "explainability")
    df = split_only(spark, sf)
    model, _ = _fit_eval(df, "logistic_regression", {"C": 1.0, "penalty": "l2"})
    write_explainability(model, df, root)
    return ArtifactStore(spark, root).latest().table("global_importance")


@register("x10_importance_merge")
def q_x10(spark, sf):
    """Impurity and permutation importance of one forest side by side."""
    df = split_only(spark, sf)
    model, _ = _fit_eval(df, "random_forest", {"n_estimators": 20, "max_depth": 6})
    test = df.filter(F.col("split") == "test")
    perm = X.permutation_importance(model, test, R.LOAN_ROLES.features, repeats=2)
    return X.importance_merge(X.impurity_importance(model), perm)


@register("m17_training_job")
def q_m17(spark, sf):
    """Three tuned and calibrated models, published as a version; the
    comparison is read back from it.  The searches are cut (README)."""
    from lendscope.plans.training import run_training
    out = run_training(loan_book(spark, sf), _folder(spark, "training"), candidates=JOB)
    return out["version"].table("comparison")


@register("m5_staged_forest_search")
def q_m5f(spark, sf):
    """Cross-validated AUC of forests of 5 to 40 trees, one fit per fold."""
    train = split_loans(spark, sf).filter(F.col("split") == "train")
    cands = [{"n_estimators": n, "max_depth": 6, "min_samples_leaf": 4} for n in (5, 10, 20, 40)]
    return _staged_summary(spark, train, "random_forest", cands)


@register("m5_staged_boosting_search")
def q_m5b(spark, sf):
    """Cross-validated AUC of boosting after 5 to 40 rounds, one fit per fold."""
    train = split_loans(spark, sf).filter(F.col("split") == "train")
    cands = [{"n_estimators": n, "max_depth": 3, "learning_rate": 0.1, "subsample": 0.8} for n in (5, 10, 20, 40)]
    return _staged_summary(spark, train, "gradient_boosting", cands)


def _staged_summary(spark, train, key, cands):
    t = M.tune_model(train, key, candidates=cands)
    sizes = spark.createDataFrame([(i, c["n_estimators"]) for i, c in enumerate(cands)], "candidate int, n_estimators int")
    return t["summary"].join(F.broadcast(sizes), "candidate").select("n_estimators", "cv_roc_auc_mean", "cv_roc_auc_std")


@register("x12_dependence_data")
def q_x12(spark, sf):
    _, (contrib, _) = _linear(spark, sf)
    return X.dependence_data(contrib, "numeric__int_rate", "numeric__dti")


@register("c15_deterministic_sample")
def q_c15(spark, sf):
    from lendscope.operators.clean import deterministic_sample
    return deterministic_sample(loans(spark, sf), 500)


@register("g12_algorithm_comparison")
def q_g12(spark, sf):
    feats = _cluster_features(spark, sf)
    km, _ = G.fit_kmeans(feats, 4)
    hier, _ = G.fit_hierarchical(feats, 4)
    gmm = G.fit_gmm(feats, 4)
    parts = [(name, G.evaluate_clustering(lab)) for name, lab in
             (("kmeans", km.transform(feats)), ("hierarchical", hier), ("gmm", gmm.transform(feats)))]
    out = None
    for name, ev in parts:
        ev = ev.withColumn("algorithm", F.lit(name))
        out = ev if out is None else out.unionByName(ev)
    return out


@register("g25_cleaned_vs_winsorized_segments")
def q_g25(spark, sf):
    """Segment the cleaned and the winsorized table, align segments by name,
    and correlate their profiles."""
    from lendscope.operators.clean import winsorize_columns
    from lendscope.plans.segmentation import SegmentationEngine
    base = kept_loans(spark, sf)
    wins = winsorize_columns(base, R.NUMERIC_FEATURES)
    a = SegmentationEngine(n_clusters=4).fit(base).state["comparison"].withColumn("dataset", F.lit("cleaned"))
    b = SegmentationEngine(n_clusters=4).fit(wins).state["comparison"].withColumn("dataset", F.lit("winsorized"))
    u = a.unionByName(b)
    c, w = u.filter(F.col("dataset") == "cleaned").alias("c"), u.filter(F.col("dataset") == "winsorized").alias("w")
    j = c.join(w, F.col("c.segment_name") == F.col("w.segment_name"), "full_outer")  # <= 2k rows
    return j.select(F.coalesce("c.segment_name", "w.segment_name").alias("segment_name"),
                    F.col("c.n_borrowers").alias("n_cleaned"), F.col("w.n_borrowers").alias("n_winsorized"),
                    F.col("c.average_default_rate").alias("rate_cleaned"),
                    F.col("w.average_default_rate").alias("rate_winsorized"),
                    F.col("c.typical_income").alias("income_cleaned"), F.col("w.typical_income").alias("income_winsorized"))


@register("io4_split_roundtrip")
def q_io4(spark, sf):
    from lendscope.sources.files import load_split, save_splits
    root = f"{checkpoint_dir(spark).rstrip('/')}/splits-{uuid.uuid4().hex}"
    save_splits(split_only(spark, sf), root)
    return load_split(spark, root, "test")


def _folder(spark, name):
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@register("io1_csv_round_trip")
def q_io1(spark, sf):
    """The loan book written as CSV in the declared column order and read back by it."""
    from lendscope.sources.files import RAW_LOAN_SCHEMA, load_raw_data
    book = loan_book(spark, sf)
    path = _folder(spark, "raw-csv")
    book.select(*[F.col(f.name) if f.name in book.columns else F.lit(None).cast(f.dataType).alias(f.name)
                  for f in RAW_LOAN_SCHEMA]).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return load_raw_data(spark, path).select("id", "term", "int_rate", "grade", "emp_length", "loan_status", "addr_state")


@register("io2_table_round_trip")
def q_io2(spark, sf):
    from lendscope.sources.files import load_table, save_table
    path = _folder(spark, "cleaned")
    save_table(loans(spark, sf), path)
    return rounded(load_table(spark, path))


@register("io5_model_round_trip")
def q_io5(spark, sf):
    """Scores of a fitted model that was saved and loaded again."""
    from lendscope.sources.files import load_model, save_model
    df = split_only(spark, sf)
    model, _ = _fit_eval(df, "logistic_regression", {"C": 1.0, "penalty": "l2"})
    path = _folder(spark, "model")
    save_model(model, path)
    return M.predict_probability(load_model(path), loans(spark, sf)).select("id", "p")


@register("io9_winsorize_job")
def q_io9(spark, sf):
    from lendscope.sources.files import load_table, save_table, winsorize_job
    src, dst = _folder(spark, "cleaned"), _folder(spark, "winsorized")
    save_table(loans(spark, sf), src)
    winsorize_job(spark, src, dst, R.NUMERIC_FEATURES)
    return rounded(load_table(spark, dst).select("id", *R.NUMERIC_FEATURES))


@register("io10_policy_json_scoring")
def q_io10(spark, sf):
    """Scoring by a policy that was written as JSON and read back."""
    path = _folder(spark, "policy")
    P.save_policy(P.RiskPolicy(), path)
    return rounded(P.score_loans(scored(spark, sf), policy=P.load_policy(path), threshold=0.5))


@register("m13_production_model")
def q_m13(spark, sf):
    """Three stand-in scores compared by exact AUC; the best one's key."""
    d = scored(spark, sf)
    names = {"Logistic Regression": F.col("p"), "Random Forest": F.col("int_rate"), "XGBoost": F.col("dti")}
    long = d.select(F.col(R.TARGET_COLUMN).alias("y"), F.inline(F.array(*[
        F.struct(F.lit(n).alias("model"), c.cast("double").alias("s")) for n, c in names.items()]))).filter("s is not null")
    table = E.rank_metrics(long, "y", "s", ["model"]).select("model", "roc_auc")
    return table.select("model", sig_round(F.col("roc_auc")).alias("roc_auc"),
                        F.lit(M.resolve_production_model_key(table)).alias("production_model"))


@register("t9_vif_two_columns")
def q_t9b(spark, sf):
    return rounded(T.variance_inflation_factors(loans(spark, sf), ["loan_amnt", "annual_inc"]))


@register("dq4_dtype_report")
def q_dq4(spark, sf):
    return DQ.dtype_report(loan_book(spark, sf))


@register("dq8_variable_descriptions")
def q_dq8(spark, sf):
    return DQ.variable_description_table(loan_book(spark, sf))


@register("p9_single_borrower")
def q_p9(spark, sf):
    """The riskiest loan (smallest id in a tie) scored as a single borrower."""
    one = scored(spark, sf).orderBy(F.desc("p"), "id").limit(1)
    return rounded(P.score_single(one, threshold=0.5))


@register("p11_policy_violations")
def q_p11(spark, sf):
    """A policy per loan grade: tiers cut at the grade's score quartiles, the
    last one left out for every second grade, checked as policies."""
    q = quantile_table_wide(exact_quantiles(scored(spark, sf), ["p"], [0.25, 0.5, 0.75], ["grade"]),
                            ["grade"], [0.25, 0.5, 0.75], ["a", "b", "c"])
    edge = lambda n, lo, hi: F.struct(F.lit(n).alias("name"), lo.cast("double").alias("min_probability"),
                                      hi.cast("double").alias("max_probability"))
    tiers = q.select(F.col("grade").alias("policy_id"), F.inline(F.array(
        edge("t1", F.lit(0.0), F.col("a")), edge("t2", F.col("a"), F.col("b")), edge("t3", F.col("b"), F.col("c")),
        edge("t4", F.col("c"), F.when(F.col("grade").isin("A", "C", "E"), F.lit(0.99)).otherwise(F.lit(1.01))))))
    act = tiers.filter("name != 't2' or policy_id != 'B'").select("policy_id", F.col("name").alias("tier"))
    return P.policy_violations({"risk_tiers": tiers, "lending_actions": act,
                                "rate_adjustments": tiers.select("policy_id", F.col("name").alias("tier"))})
