import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.operators import evaluate as E
from lendscope.operators import fairness as N
from lendscope.operators import hypothesis as T
from lendscope.operators import policy as P


def _yp(spark, ys, ps, extra=None):
    rows = [(int(y), float(p), (extra[i] if extra else "g")) for i, (y, p) in enumerate(zip(ys, ps))]
    return spark.createDataFrame(rows, "y int, p double, g string")


def _auc_brute(ys, ps):
    pos = [p for y, p in zip(ys, ps) if y == 1]
    neg = [p for y, p in zip(ys, ps) if y == 0]
    s = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def _ap_brute(ys, ps):
    order = sorted(set(ps), reverse=True)
    npos = sum(ys)
    ap, prev_r = 0.0, 0.0
    for t in order:
        tp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 1)
        fp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 0)
        r = tp / npos
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def test_rank_metrics_match_brute_force(spark):
    rng = np.random.default_rng(3)
    ys = list(rng.integers(0, 2, 400))
    ps = list(np.round(rng.random(400), 2))  # many ties
    r = E.rank_metrics(_yp(spark, ys, ps), "y", "p").first()
    assert math.isclose(r.roc_auc, _auc_brute(ys, ps), rel_tol=1e-12)
    assert math.isclose(r.average_precision, _ap_brute(ys, ps), rel_tol=1e-12)


def test_one_class_group_gives_null_auc(spark):
    r = E.rank_metrics(_yp(spark, [1, 1, 1], [0.2, 0.3, 0.4]), "y", "p").first()
    assert r.roc_auc is None


def test_ece_values(spark):
    ys = [1] + [0] * 9
    assert E.expected_calibration_error(_yp(spark, ys, [0.1] * 10)).first()[0] == pytest.approx(0.0, abs=1e-12)
    assert E.expected_calibration_error(_yp(spark, ys, [0.9] * 10)).first()[0] > 0.5


def test_threshold_cost(spark):
    t = E.threshold_metrics_table(_yp(spark, [1, 1, 0, 0], [0.9, 0.1, 0.9, 0.1]), "y", "p", thresholds=[0.5])
    assert t.first().expected_cost_per_loan == pytest.approx((1 * 5 + 1 * 1) / 4)


def test_recommend_threshold_picks_min_cost(spark):
    t = spark.createDataFrame([(0.1, 0.8), (0.3, 0.2), (0.5, 0.5)], "threshold double, expected_cost_per_loan double")
    assert E.recommend_threshold(t).first().threshold == 0.3


def test_threshold_table_matches_direct_counts(spark):
    rng = np.random.default_rng(5)
    ys, ps = list(rng.integers(0, 2, 300)), list(rng.random(300))
    tab = {round(r.threshold, 2): r for r in E.threshold_metrics_table(_yp(spark, ys, ps), "y", "p").collect()}
    for t in (0.05, 0.5, 0.95):
        flagged = sum(1 for p in ps if p >= t)
        assert tab[t].n_flagged_as_risky == flagged


def test_fairness_skips_small_groups(spark):
    rng = np.random.default_rng(1)
    grp = ["a"] * 50 + ["b"] * 45 + ["c"] * 5
    df = _yp(spark, list(rng.integers(0, 2, 100)), list(rng.random(100)), grp)
    rep = N.fairness_report(df.withColumnRenamed("g", "home"), ["home", "missing_col"], "y", "p")
    assert sorted(r.group_value for r in rep.collect()) == ["a", "b"]
    s = N.summarize_disparities(rep, "roc_auc").first()
    assert s.spread >= 0


def test_perfect_line_correlations(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "a double, b double")
    for m in ("pearson", "spearman"):
        assert T.correlation_tests(df, [("a", "b")], m).first().statistic == pytest.approx(1.0)


def test_chi_square_yates_2x2(spark):
    rows = [(0, 0)] * 20 + [(0, 1)] * 10 + [(1, 0)] * 5 + [(1, 1)] * 15
    df = spark.createDataFrame(rows, "a int, b int")
    r = T.chi_square_tests(df, ["a"], "b").first()
    o = np.array([[20, 10], [5, 15]], dtype=float)
    e = o.sum(1)[:, None] * o.sum(0)[None, :] / o.sum()
    expect = (((np.abs(o - e) - 0.5) ** 2) / e).sum()
    assert r.statistic == pytest.approx(expect)


def test_welch_t_and_p_value(spark):
    a = [1.0, 2.0, 3.0, 4.0, 5.0]
    b = [2.0, 4.0, 6.0, 8.0, 10.0, 12.0]
    df = spark.createDataFrame([(x, 0) for x in a] + [(x, 1) for x in b], "x double, default_flag int")
    r = T.with_p_values(T.welch_t_tests(df, ["x"])).first()
    va, vb = np.var(a, ddof=1), np.var(b, ddof=1)
    t = (np.mean(a) - np.mean(b)) / math.sqrt(va / 5 + vb / 6)
    assert r.statistic == pytest.approx(t) and 0 < r.p_value < 0.05


def test_scoring_and_tier_distribution(spark):
    df = spark.createDataFrame([(1, 0.05), (2, 0.2), (3, 0.7)], "id long, p double")
    s = P.score_loans(df).orderBy("id").collect()
    assert [r.risk_tier for r in s] == ["Low Risk", "Moderate Risk", "Very High Risk"]
    assert s[0].recommended_rate == 9.5 and s[2].lending_action == "Decline"
    dist = {r.risk_tier: r.n_loans for r in P.tier_distribution(P.score_loans(df)).collect()}
    assert dist["High Risk"] == 0 and sum(dist.values()) == 3


def test_borrower_sentence(spark):
    df = spark.createDataFrame(
        [("High Risk", 0.425, ["Debt-to-income ratio", "Interest rate", "LendingClub credit grade", "X"],
          ["Annual income"], "Manual Review")], "t string, p double, r array<string>, q array<string>, a string")
    s = df.select(P.borrower_sentence(F.col("t"), F.col("p"), F.col("r"), F.col("q"), F.col("a"))).first()[0]
    assert s == ("This borrower is classified as High Risk (estimated 42% likelihood of default). This is primarily "
                 "driven by debt-to-income ratio, interest rate, and LendingClub credit grade. On the positive side, "
                 "annual income help offset some of this risk. Recommended action: Manual Review.")


def test_policy_round_trip_and_violations(spark, tmp_path):
    pol = P.RiskPolicy()
    path = str(tmp_path / "policy.json")
    P.save_policy(pol, path)
    assert P.load_policy(path).to_dict() == pol.to_dict()
    assert P.policy_violations(pol.tables(spark)).count() == 0
    bad = P.RiskPolicy(risk_tiers=[("Low Risk", 0.0, 0.1, ""), ("Moderate Risk", 0.2, 0.35, ""),
                                   ("High Risk", 0.35, 0.6, ""), ("Very High Risk", 0.6, 0.9, "")])
    checks = {r.check for r in P.policy_violations(bad.tables(spark)).collect()}
    assert {"gap", "does_not_cover_1"} <= checks
    t = P.read_policy_tables(spark, path)
    assert t["risk_tiers"].count() == 4 and t["rate_adjustments"].count() == 4
