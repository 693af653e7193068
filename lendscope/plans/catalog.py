"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the given tables (or data Spark derives from them), runs
over whole tables, and names its output columns exactly as the matching SQL
oracle in ``lendscope.plans.oracles``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lendscope import roles as R
from lendscope.operators import clean as C
from lendscope.operators import describe as A
from lendscope.plans.inputs import loans, rounded, scored
from lendscope.sources.tables import loan_book

QUERIES: dict = {}


def register(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- cleaning
@register("c7_clean_dataset")
def q_c7(spark, sf):
    return rounded(loans(spark, sf))


# ---------------------------------------------------------------- rates
@register("a1_default_rate_by_grade")
def q_a1(spark, sf):
    return A.default_rate_by_group(loans(spark, sf), "grade")


@register("a3_default_rate_ci_by_purpose")
def q_a3(spark, sf):
    return A.default_rate_ci_by_group(loans(spark, sf), "purpose")


@register("a4_numeric_descriptive_stats")
def q_a4(spark, sf):
    return rounded(A.numeric_descriptive_stats(loans(spark, sf), R.NUMERIC_FEATURES, decimals=None))


# ============================================================ data quality
from lendscope.operators import quality as DQ  # noqa: E402
from lendscope.operators import bands as B  # noqa: E402
from lendscope.operators import evaluate as E  # noqa: E402
from lendscope.operators import fairness as N  # noqa: E402
from lendscope.operators import hypothesis as T  # noqa: E402
from lendscope.operators import policy as P  # noqa: E402
from lendscope.functions import text as TX  # noqa: E402
from lendscope.sources.tables import read_table  # noqa: E402


@register("dq2_missing_summary")
def q_dq2(spark, sf):
    return DQ.missing_summary(loan_book(spark, sf))


@register("dq3_duplicate_rows")
def q_dq3(spark, sf):
    return DQ.duplicate_row_count(loan_book(spark, sf))


@register("dq3_duplicate_documents")
def q_dq3d(spark, sf):
    return DQ.duplicate_row_count(read_table(spark, sf, "documents").select("text", "lang", "source"))


@register("dq5_business_rules")
def q_dq5(spark, sf):
    return DQ.business_rule_counts(loan_book(spark, sf))


@register("dq6_validate_dataset")
def q_dq6(spark, sf):
    return DQ.validate_dataset(loan_book(spark, sf))


@register("dq7_dataset_overview")
def q_dq7(spark, sf):
    return DQ.dataset_overview(loans(spark, sf))


@register("dq9_missing_matrix")
def q_dq9(spark, sf):
    return DQ.missing_matrix(loan_book(spark, sf), id_col="id")


# ============================================================ cleaning
@register("c1_filter_to_state")
def q_c1(spark, sf):
    return C.filter_to_target_state(loan_book(spark, sf), "NATION_17").select("id", "addr_state", "loan_status")


@register("c2_remove_duplicates")
def q_c2(spark, sf):
    return C.remove_duplicate_rows(read_table(spark, sf, "documents"))


@register("c3_parse_percentages")
def q_c3(spark, sf):
    return rounded(C.clean_percentage_columns(loan_book(spark, sf).select("id", "int_rate", "revol_util")))


@register("c4_parse_emp_length")
def q_c4(spark, sf):
    return C.parse_emp_length(loan_book(spark, sf).select("id", "emp_length")).drop("emp_length")


@register("c5_create_target")
def q_c5(spark, sf):
    return C.create_target_variable(loan_book(spark, sf).select("id", "loan_status")).drop("loan_status")


@register("c8_winsorize")
def q_c8(spark, sf):
    df = loans(spark, sf)
    return rounded(C.winsorize_columns(df, R.NUMERIC_FEATURES).select("id", *R.NUMERIC_FEATURES))


@register("c9_clip_counts")
def q_c9(spark, sf):
    df = loans(spark, sf)
    return rounded(C.clip_counts(df, C.fit_bounds(df, R.NUMERIC_FEATURES, k=1.5)))


@register("c10_borrower_filters")
def q_c10(spark, sf):
    df = loans(spark, sf)
    return rounded(C.apply_borrower_filters(
        df, {"grade": ["A", "B", "C"], "purpose": ["BUILDING", "MACHINERY"], "home_ownership": []},
        {"loan_amnt": (10000.0, 40000.0), "annual_inc": (0.0, 80000.0), "dti": (5.0, 45.0)})
        .select("id", "grade", "purpose", "loan_amnt", "annual_inc", "dti"))


@register("c11_filter_domains")
def q_c11(spark, sf):
    return rounded(C.filter_domains(loans(spark, sf), ["loan_amnt", "annual_inc", "dti", "int_rate"],
                                    ["grade", "purpose", "home_ownership"]))


@register("c12_category_labels")
def q_c12(spark, sf):
    df = loans(spark, sf)
    return df.select("id", TX.category_label("term", F.col("term")).alias("term_label"),
                     TX.category_label("purpose", F.col("purpose")).alias("purpose_label"),
                     TX.category_label("home_ownership", F.col("home_ownership")).alias("home_label"),
                     TX.category_label("initial_list_status", F.col("initial_list_status")).alias("list_label"))


def _feature_names(spark, sf):
    """Pipeline output names derived from the data: numeric, ordinal and
    one one-hot name per observed category."""
    df = loans(spark, sf)
    cats = df.select(F.inline(F.array(*[
        F.struct(F.concat(F.lit(f"onehot_categorical__{c}_"), F.col(c)).alias("feature"))
        for c in R.ONEHOT_FEATURES]))).filter(F.col("feature").isNotNull()).distinct()
    fixed = spark.createDataFrame([(f"numeric__{c}",) for c in R.NUMERIC_FEATURES] +
                                  [("ordinal_categorical__grade",)], "feature string")
    return cats.unionByName(fixed)


@register("c13_humanize_feature_names")
def q_c13(spark, sf):
    f = _feature_names(spark, sf)
    return f.select("feature", TX.humanize_feature_name(F.col("feature")).alias("feature_label"))


@register("c14_research_question_links")
def q_c14(spark, sf):
    f = _feature_names(spark, sf)
    return f.select("feature", TX.research_question(F.col("feature")).alias("research_question"))


@register("c16_form_defaults")
def q_c16(spark, sf):
    return rounded(C.form_defaults(loans(spark, sf), ["loan_amnt", "annual_inc", "dti", "int_rate"],
                                   ["grade", "purpose", "home_ownership", "term"]))


# ============================================================ banding
@register("b1_quartile_bins")
def q_b1(spark, sf):
    df = loans(spark, sf)
    out = B.bin_into_quantiles(df, "annual_inc", 4, out="income_quartile")
    out = B.bin_into_quantiles(out, "int_rate", 4, out="rate_quartile")
    return A.default_rate_by_group(out, "income_quartile").withColumn("band", F.lit("income")) \
        .withColumnRenamed("income_quartile", "bin").unionByName(
            A.default_rate_by_group(out, "rate_quartile").withColumn("band", F.lit("rate"))
            .withColumnRenamed("rate_quartile", "bin"))


@register("b2_fixed_bands")
def q_b2(spark, sf):
    df = loans(spark, sf)
    out = B.bin_into_bands(df, "dti", [0, 10, 20, 30, 40, 60], ["0-10", "10-20", "20-30", "30-40", "40+"],
                           out="dti_band")
    return A.default_rate_by_group(out, "dti_band")


@register("b3_policy_bands")
def q_b3(spark, sf):
    pol = P.RiskPolicy()
    s = scored(spark, sf)
    return s.select("id", pol.tier_expr(F.col("p")).alias("risk_tier"),
                    pol.grade_expr(F.col("p")).alias("model_loan_grade"))


# ============================================================ descriptive
@register("a2_default_rate_summary")
def q_a2(spark, sf):
    return rounded(A.default_rate_summary(loans(spark, sf), "grade"))


@register("a5_frequency_table")
def q_a5(spark, sf):
    return A.categorical_frequency_table(loans(spark, sf), "emp_length_years")


@register("a6_skew_kurtosis_verdicts")
def q_a6(spark, sf):
    st = A.numeric_descriptive_stats(loans(spark, sf), R.NUMERIC_FEATURES, decimals=None)
    return st.select("variable", A.skew_kurtosis_verdict(F.col("skewness"), F.col("excess_kurtosis"))
                     .alias("interpretation"))


@register("a7_portfolio_kpis")
def q_a7(spark, sf):
    df = C.apply_borrower_filters(loans(spark, sf), {"grade": ["A", "B", "C", "D"]}, {})
    return rounded(A.portfolio_kpis(df))


@register("a8_category_distribution")
def q_a8(spark, sf):
    return A.category_distribution(loans(spark, sf), "purpose")


@register("a9_riskiest_group")
def q_a9(spark, sf):
    return A.riskiest_group(loans(spark, sf), "addr_state")


@register("a10_categorical_spread")
def q_a10(spark, sf):
    return rounded(A.categorical_spread_ranking(loans(spark, sf), R.ONEHOT_FEATURES + ["grade"]))


@register("a11_target_balance")
def q_a11(spark, sf):
    return A.target_balance(loans(spark, sf))


def _emb(spark, sf):
    """(rows, names): a column for every dimension that any embedding has."""
    e = read_table(spark, sf, "embeddings")
    names = [f"e{i}" for i in range(e.agg(F.max(F.size("embedding"))).first()[0] or 0)]
    return e.select("vec_id", F.col("label").alias("cluster"),
                    *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(names)]), names


@register("a12_feature_by_cluster")
def q_a12(spark, sf):
    e, names = _emb(spark, sf)
    return rounded(A.aggregate_by_cluster(e, "cluster", names, "avg"))


@register("a12_median_by_cluster")
def q_a12m(spark, sf):
    """Exact medians of the loans' amounts and rates per grade."""
    return rounded(A.aggregate_by_cluster(loans(spark, sf), "grade", ["loan_amnt", "int_rate", "dti"], "median"))


@register("a13_cluster_sizes")
def q_a13(spark, sf):
    return rounded(A.cluster_sizes(_emb(spark, sf)[0]))


@register("a14_cluster_zscore_profile")
def q_a14(spark, sf):
    e, names = _emb(spark, sf)
    return rounded(A.cluster_zscore_profile(e, "cluster", names))


@register("a15_histogram")
def q_a15(spark, sf):
    return rounded(A.histogram(read_table(spark, sf, "events"), "value", 40))


@register("a15_histogram_by_outcome")
def q_a15b(spark, sf):
    return rounded(A.histogram(loans(spark, sf), "int_rate", 30, by="default_flag"))


@register("a15_score_density_by_outcome")
def q_a15s(spark, sf):
    """Predicted-score histograms per actual outcome: 30 bins over each
    outcome's own range, as densities."""
    d = scored(spark, sf).select("default_flag", "p")
    return rounded(A.histogram(d, "p", 30, by="default_flag", per_group_range=True, density=True))


@register("a16_box_stats_by_group")
def q_a16(spark, sf):
    return rounded(A.box_stats(read_table(spark, sf, "events"), ["value"], group="event_type"))


@register("a17_density_2d")
def q_a17(spark, sf):
    return A.density_2d(loans(spark, sf), "int_rate", "dti", 20)


@register("a18_kde_curve")
def q_a18(spark, sf):
    return rounded(A.kde_curve(read_table(spark, sf, "events"), "value", grid_points=50, bins=128,
                               by="event_type"))


# ============================================================ tests
TTEST_COLS = ["loan_amnt", "int_rate", "annual_inc", "dti", "revol_util", "emp_length_years"]
CHI_COLS = ["term", "home_ownership", "verification_status", "purpose", "initial_list_status",
            "application_type", "grade"]


@register("t2_welch_t_tests")
def q_t2(spark, sf):
    return rounded(T.welch_t_tests(loans(spark, sf), TTEST_COLS))


@register("t3_anova_by_grade")
def q_t3(spark, sf):
    return rounded(T.anova_tests(loans(spark, sf), ["loan_amnt", "int_rate"], "grade"))


@register("t3_anova_doc_length_by_lang")
def q_t3d(spark, sf):
    return rounded(T.anova_tests(read_table(spark, sf, "documents"), ["n_chars"], "lang"))


@register("t4_chi_square_tests")
def q_t4(spark, sf):
    return rounded(T.chi_square_tests(loans(spark, sf), CHI_COLS))


@register("t4_chi_square_yates_labels")
def q_t4y(spark, sf):
    return rounded(T.chi_square_tests(read_table(spark, sf, "labels"), ["quality"], "toxic"))


CORR_PAIRS = [("int_rate", "dti"), ("loan_amnt", "installment"), ("annual_inc", "loan_amnt"),
              ("revol_util", "int_rate"), ("open_acc", "total_acc")]


@register("t6_pearson")
def q_t6p(spark, sf):
    return rounded(T.correlation_tests(loans(spark, sf), CORR_PAIRS, "pearson"))


@register("t6_spearman")
def q_t6s(spark, sf):
    return rounded(T.correlation_tests(loans(spark, sf), CORR_PAIRS, "spearman"))


@register("t7_correlation_matrix")
def q_t7(spark, sf):
    return rounded(T.correlation_matrix(loans(spark, sf), R.NUMERIC_FEATURES))


@register("t7_spearman_matrix")
def q_t7s(spark, sf):
    return rounded(T.correlation_matrix(loans(spark, sf), R.NUMERIC_FEATURES, "spearman"))


@register("t8_high_correlation_pairs")
def q_t8(spark, sf):
    return rounded(T.high_correlation_pairs(T.correlation_matrix(loans(spark, sf), R.NUMERIC_FEATURES), 0.4))


@register("t10_target_correlation_rank")
def q_t10(spark, sf):
    df = loans(spark, sf).withColumn("grade_index", A.order_index(F.col("grade"), R.GRADE_ORDER))
    return rounded(T.target_correlation_ranking(df, R.NUMERIC_FEATURES + ["grade_index"]))


@register("t11_test_battery_with_p")
def q_t11(spark, sf):
    df = loans(spark, sf)
    parts = [T.welch_t_tests(df, TTEST_COLS),
             T.anova_tests(df, ["loan_amnt", "int_rate"], "grade"),
             T.chi_square_tests(df, CHI_COLS),
             T.correlation_tests(df, CORR_PAIRS, "pearson"),
             T.correlation_tests(df, CORR_PAIRS, "spearman")]
    u = parts[0]
    for x in parts[1:]:
        u = u.unionByName(x, allowMissingColumns=True)  # family-specific fields stay, NULL elsewhere
    return T.with_p_values(u)


# ============================================================ evaluation
def _yp(spark, sf):
    return scored(spark, sf).select("id", F.col("default_flag").alias("y"), "p", "grade",
                                    "home_ownership", "purpose", "term")


@register("e1_confusion_counts")
def q_e1(spark, sf):
    return E.confusion_counts(_yp(spark, sf), threshold=0.5)


@register("e2_classification_metrics")
def q_e2(spark, sf):
    return rounded(E.classification_metrics(_yp(spark, sf), threshold=0.5))


@register("e3_rank_metrics_by_grade")
def q_e3(spark, sf):
    return rounded(E.rank_metrics(_yp(spark, sf), keys=["grade"]))


@register("e5_probability_scores")
def q_e5(spark, sf):
    return rounded(E.probability_scores(_yp(spark, sf)))


@register("e7_expected_calibration_error")
def q_e7(spark, sf):
    return rounded(E.expected_calibration_error(_yp(spark, sf)))


@register("e8_reliability_curve")
def q_e8(spark, sf):
    return rounded(E.reliability_curve(_yp(spark, sf)))


@register("e9_roc_pr_points")
def q_e9(spark, sf):
    return rounded(E.roc_points(_yp(spark, sf)))


@register("e11_threshold_table")
def q_e11(spark, sf):
    return rounded(E.threshold_metrics_table(_yp(spark, sf)))


@register("e13_recommend_threshold")
def q_e13(spark, sf):
    return rounded(E.recommend_threshold(E.threshold_metrics_table(_yp(spark, sf), keys=["term"]), ["term"]))


def _two_models(spark, sf):
    s = scored(spark, sf)
    a = s.select(F.lit("score_a").alias("model"), F.col("default_flag").alias("y"), "p")
    b = s.select(F.lit("score_b").alias("model"), F.col("default_flag").alias("y"),
                 (((F.col("id") * 16807) % 1000) / 1000.0 * 0.5 + F.col("default_flag") * 0.3).alias("p"))
    return a.unionByName(b)


@register("e14_calibration_report")
def q_e14(spark, sf):
    return rounded(E.calibration_report(_two_models(spark, sf), keys=["model"]))


# ============================================================ fairness
@register("n1_fairness_report")
def q_n1(spark, sf):
    return rounded(N.fairness_report(_yp(spark, sf), ["home_ownership", "purpose", "grade"]))


@register("n2_fairness_disparities")
def q_n2(spark, sf):
    rep = N.fairness_report(_yp(spark, sf), ["home_ownership", "purpose", "grade"])
    return rounded(N.summarize_disparities(rep, "recall"))


# ============================================================ policy
@register("p2_predict_labels")
def q_p2(spark, sf):
    return P.predict_label(scored(spark, sf).select("id", "p"), threshold=0.35).drop("p")


@register("p8_batch_scoring")
def q_p8(spark, sf):
    return rounded(P.score_loans(scored(spark, sf), threshold=0.5))


@register("p10_tier_distribution")
def q_p10(spark, sf):
    return rounded(P.tier_distribution(P.score_loans(scored(spark, sf))))


from lendscope.plans import catalog_ml  # noqa: E402,F401  (registers the ML queries)
