"""DuckDB oracles for split/fold allocation, class weights, cluster-validity
indices, centroids, nearest-centroid assignment, segment profiles and
score-by-cluster tables."""

from __future__ import annotations

from lendscope import roles as R
from lendscope.plans.oracles_base import with_loans, with_raw, with_scored
from lendscope.plans.oracles_more import _qlabel, _qbin, q, r

O: dict = {}

_REL = repr(R.VALIDATION_SIZE / (1 - R.TEST_SIZE))
_TS = repr(R.TEST_SIZE)


def _alloc(prefix: str, counts: str, draws: str) -> str:
    """Two-class proportional allocation: floor, then the larger remainder
    (ties -> class 0) gets the leftover draw."""
    return f"""
, {prefix}_c AS (SELECT *, c0 / CAST(c0 + c1 AS DOUBLE) * {draws} AS x0, c1 / CAST(c0 + c1 AS DOUBLE) * {draws} AS x1 FROM {counts})
, {prefix} AS (SELECT *, CAST(floor(x0) AS BIGINT) + CASE WHEN {draws} - floor(x0) - floor(x1) >= 1 AND x0 - floor(x0) >= x1 - floor(x1) THEN 1 ELSE 0 END AS a0,
      CAST(floor(x1) AS BIGINT) + CASE WHEN {draws} - floor(x0) - floor(x1) >= 1 AND x0 - floor(x0) < x1 - floor(x1) THEN 1 ELSE 0 END
      + CASE WHEN {draws} - floor(x0) - floor(x1) >= 2 THEN 1 ELSE 0 END AS a1 FROM {prefix}_c)"""


O["f9_stratified_split_counts"] = with_loans(f"""
, cc AS (SELECT count(*) FILTER (WHERE default_flag = 0) AS c0, count(*) FILTER (WHERE default_flag = 1) AS c1 FROM loans)
, s1 AS (SELECT c0, c1, (c0 + c1) - CAST(ceil(CAST({_TS} AS DOUBLE) * (c0 + c1)) AS BIGINT) AS ntr1 FROM cc)
{_alloc('t1', 's1', 'ntr1')}
, s2 AS (SELECT c0 AS o0, c1 AS o1, a0 AS c0, a1 AS c1,
           (a0 + a1) - CAST(ceil(CAST({_REL} AS DOUBLE) * (a0 + a1)) AS BIGINT) AS ntr2 FROM t1)
{_alloc('t2', 's2', 'ntr2')}
, res AS (
  SELECT 'test' AS split, 0 AS default_flag, o0 - c0 AS n FROM t2 UNION ALL SELECT 'test', 1, o1 - c1 FROM t2
  UNION ALL SELECT 'val', 0, c0 - a0 FROM t2 UNION ALL SELECT 'val', 1, c1 - a1 FROM t2
  UNION ALL SELECT 'train', 0, a0 FROM t2 UNION ALL SELECT 'train', 1, a1 FROM t2)
SELECT split, CAST(default_flag AS INTEGER) AS default_flag, CAST(n AS BIGINT) AS n FROM res WHERE n > 0""")

O["f10_stratified_fold_counts"] = with_loans(f"""
, cc AS (SELECT default_flag, count(*) AS c FROM loans GROUP BY default_flag)
, f AS (SELECT CAST(range AS INTEGER) AS fold FROM range(0, {R.CV_FOLDS}))
SELECT fold, default_flag, CAST(((c - 1 - fold) // {R.CV_FOLDS}) + 1 AS BIGINT) AS n FROM cc, f WHERE fold < c""")

O["m6_class_weights"] = with_loans("""
, cc AS (SELECT default_flag, count(*) AS c FROM loans GROUP BY default_flag)
SELECT default_flag, CAST((SELECT sum(c) FROM cc) AS DOUBLE) / (2 * c) AS weight, c AS count FROM cc""")

_NUMF = R.NUMERIC_FEATURES
_NOMF = R.ONEHOT_FEATURES


def _mode_sql(c: str) -> str:
    return (f"(SELECT CAST({c} AS VARCHAR) FROM loans WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, CAST({c} AS VARCHAR) LIMIT 1)")


_IMPUTED = (", med AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in _NUMF) + " FROM loans)"
            ", imp AS (SELECT id, " + ", ".join(f"coalesce({c}, (SELECT {c} FROM med)) AS {c}" for c in _NUMF)
            + ", " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), {_mode_sql(c)}) AS {c}" for c in _NOMF + ['grade'])
            + " FROM loans)"
            ", st AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _NUMF) + " FROM imp)"
            ", ordv AS (SELECT id, CAST(coalesce(list_position(['A','B','C','D','E','F','G'], grade) - 1, -1) AS DOUBLE)"
            " AS g FROM imp)")


def _scaled(c: str, mean: str, sd: str) -> str:
    return f"({c} - {mean}) / CASE WHEN {sd} > 0 THEN {sd} ELSE 1.0 END"


_NUM_LONG = " UNION ALL ".join(
    f"SELECT id, 'numeric__{c}' AS feature, {_scaled(c, f'm_{c}', f's_{c}')} AS value FROM imp, st" for c in _NUMF)

O["f6_preprocessing_fit_all"] = with_loans(_IMPUTED + ", fl AS (" + _NUM_LONG + " UNION ALL " + " UNION ALL ".join(
    f"SELECT id, 'onehot_categorical__{c}_' || lab, CASE WHEN imp.{c} = lab THEN 1.0 ELSE 0.0 END "
    f"FROM imp, (SELECT DISTINCT {c} AS lab FROM imp) labs" for c in _NOMF)
    + " UNION ALL SELECT id, 'ordinal_categorical__grade', g FROM ordv)\n"
    f"SELECT id, feature, {r('value')} AS value FROM fl")

O["f8_clustering_features"] = with_loans(
    _IMPUTED + ", gst AS (SELECT avg(g) AS gm, stddev_pop(g) AS gs FROM ordv)"
    ", fl AS (" + _NUM_LONG + f" UNION ALL SELECT id, 'ordinal_categorical__grade', {_scaled('g', 'gm', 'gs')} "
    "FROM ordv, gst)\n"
    f"SELECT id, feature, {r('value')} AS value FROM fl")

_EMB_LONG = """WITH long AS (
  SELECT vec_id AS row_id, label AS cluster, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS pos,
         CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
, cl AS (SELECT cluster, pos, avg(x) AS c, count(*) AS n FROM long GROUP BY cluster, pos)
"""

O["g7_calinski_harabasz"] = _EMB_LONG + f"""
, overall AS (SELECT pos, avg(x) AS g FROM long GROUP BY pos)
, sizes AS (SELECT cluster, count(DISTINCT row_id) AS nc FROM long GROUP BY cluster)
, b AS (SELECT sum(nc * power(c - g, 2)) AS bb FROM cl JOIN overall USING (pos) JOIN sizes USING (cluster))
, w AS (SELECT sum(power(x - c, 2)) AS ww FROM long JOIN cl USING (cluster, pos))
, kn AS (SELECT count(*) AS k, sum(nc) AS n FROM sizes)
SELECT {r('CASE WHEN k > 1 AND ww > 0 THEN (bb / (k - 1)) / (ww / (n - k)) END')} AS calinski_harabasz FROM b, w, kn"""

O["g8_davies_bouldin"] = _EMB_LONG + f"""
, d AS (SELECT cluster, row_id, sqrt(sum(power(x - c, 2))) AS dist FROM long JOIN cl USING (cluster, pos) GROUP BY cluster, row_id)
, s AS (SELECT cluster, avg(dist) AS s FROM d GROUP BY cluster)
, pr AS (SELECT a.cluster AS ci, b.cluster AS cj, sqrt(sum(power(a.c - b.c, 2))) AS dij
         FROM cl a JOIN cl b ON a.pos = b.pos AND a.cluster <> b.cluster GROUP BY a.cluster, b.cluster)
, rr AS (SELECT ci, max((si.s + sj.s) / dij) AS m FROM pr JOIN s si ON si.cluster = ci JOIN s sj ON sj.cluster = cj GROUP BY ci)
SELECT {r('avg(m)')} AS davies_bouldin FROM rr"""

O["g15_assign_nearest_centroid"] = _EMB_LONG + """
, dd AS (SELECT l.row_id, cl.cluster AS cand, sum(power(l.x - cl.c, 2)) AS d FROM long l JOIN cl ON l.pos = cl.pos
         GROUP BY l.row_id, cl.cluster)
, best AS (SELECT row_id, cand FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d, cand) AS rn FROM dd) WHERE rn = 1)
SELECT e.vec_id, e.label, best.cand AS assigned FROM embeddings e JOIN best ON best.row_id = e.vec_id"""

O["g16_centroids"] = _EMB_LONG + f"SELECT cluster, pos AS dim, {r('c')} AS center FROM cl"

_SEG = (", seg AS (SELECT *, CAST(list_position(['A','B','C','D','E','F','G'], grade) - 1 AS INTEGER) AS cluster "
        "FROM scored)")
_PNUM = R.PROFILE_NUMERIC_COLUMNS


def _mode_by_cluster(c: str) -> str:
    return (f"(SELECT cluster, {c} FROM (SELECT cluster, CAST({c} AS VARCHAR) AS {c}, row_number() OVER "
            f"(PARTITION BY cluster ORDER BY count(*) DESC, CAST({c} AS VARCHAR)) AS rn FROM seg "
            f"WHERE {c} IS NOT NULL GROUP BY cluster, {c}) WHERE rn = 1)")


_PROFILE = _SEG + f"""
, pg AS (SELECT cluster AS cluster_id, count(*) AS n_borrowers, {", ".join(f"avg({c}) AS {c}" for c in _PNUM)},
           avg(CAST(default_flag AS DOUBLE)) AS average_default_rate FROM seg GROUP BY cluster)
, prof AS (SELECT pg.*, n_borrowers / sum(n_borrowers) OVER () AS pct_of_portfolio, mg.grade, mh.home_ownership, mp.purpose
           FROM pg LEFT JOIN {_mode_by_cluster('grade')} mg ON mg.cluster IS NOT DISTINCT FROM pg.cluster_id
           LEFT JOIN {_mode_by_cluster('home_ownership')} mh ON mh.cluster IS NOT DISTINCT FROM pg.cluster_id
           LEFT JOIN {_mode_by_cluster('purpose')} mp ON mp.cluster IS NOT DISTINCT FROM pg.cluster_id)
"""

O["g17_cluster_profile"] = with_scored(_PROFILE + "SELECT cluster_id, n_borrowers, " + ", ".join(
    f"{r(c)} AS {c}" for c in _PNUM) + f", {r('average_default_rate')} AS average_default_rate, "
    f"{r('pct_of_portfolio')} AS pct_of_portfolio, grade, home_ownership, purpose FROM prof")

from lendscope.operators.segments import RECOMMENDATIONS, RECOMMENDATION_FIELDS  # noqa: E402
from lendscope.plans.oracles_more import band_sql  # noqa: E402

_TIER = band_sql("average_default_rate", R.RISK_TIERS)
_ACTIONS = ", ".join(
    "coalesce(CASE risk_tier " + " ".join(f"WHEN {q(t)} THEN {q(txt[i])}" for t, txt in RECOMMENDATIONS.items())
    + f" END, {q(RECOMMENDATIONS['Unknown'][i])}) AS {f}" for i, f in enumerate(RECOMMENDATION_FIELDS))
O["g20_segment_actions"] = with_scored(_PROFILE + f"""
, t AS (SELECT cluster_id, average_default_rate, CAST(NULL AS DOUBLE) AS mean_predicted_probability,
          CASE WHEN average_default_rate IS NOT NULL THEN {_TIER} ELSE 'Unknown' END AS risk_tier FROM prof)
SELECT cluster_id, {r('average_default_rate')} AS average_default_rate, mean_predicted_probability, risk_tier, {_ACTIONS}
FROM t""")

def _z(col: str) -> str:
    return (f"CASE WHEN stddev_pop({col}) OVER () > 0 THEN ({col} - avg({col}) OVER ()) / stddev_pop({col}) OVER () "
            f"ELSE 0.0 END")


_NAMES = _PROFILE + f"""
, z AS (SELECT cluster_id, {_z('average_default_rate')} AS risk, {_z('annual_inc')} AS inc, {_z('dti')} AS dz,
          {_z('emp_length_years')} AS emp, {_z('revol_util')} AS util FROM prof)
, p1 AS (SELECT cluster_id AS c FROM (SELECT * FROM z ORDER BY risk DESC, cluster_id LIMIT 1) WHERE risk > 0.5)
, p2 AS (SELECT cluster_id AS c FROM (SELECT * FROM z WHERE cluster_id NOT IN (SELECT c FROM p1)
           ORDER BY -risk + inc DESC, cluster_id LIMIT 1) WHERE risk < 0 AND inc > 0)
, p3 AS (SELECT cluster_id AS c FROM (SELECT * FROM z WHERE cluster_id NOT IN (SELECT c FROM p1 UNION ALL SELECT c FROM p2)
           ORDER BY dz DESC, cluster_id LIMIT 1) WHERE dz > 0.5)
, p4 AS (SELECT cluster_id AS c FROM (SELECT * FROM z WHERE cluster_id NOT IN
           (SELECT c FROM p1 UNION ALL SELECT c FROM p2 UNION ALL SELECT c FROM p3)
           ORDER BY -util DESC, cluster_id LIMIT 1) WHERE util < -0.3 AND risk <= 0.5)
, p5 AS (SELECT cluster_id AS c FROM (SELECT * FROM z WHERE cluster_id NOT IN
           (SELECT c FROM p1 UNION ALL SELECT c FROM p2 UNION ALL SELECT c FROM p3 UNION ALL SELECT c FROM p4)
           ORDER BY -emp + inc DESC, cluster_id LIMIT 1) WHERE emp < 0 AND inc > 0)
, named AS (SELECT c, 'High Risk Borrowers' AS nm FROM p1 UNION ALL SELECT c, 'Prime Borrowers' FROM p2
            UNION ALL SELECT c, 'High Debt Borrowers' FROM p3 UNION ALL SELECT c, 'Credit Rebuilders' FROM p4
            UNION ALL SELECT c, 'Young Professionals' FROM p5)
, rest AS (SELECT cluster_id AS c, row_number() OVER (ORDER BY risk, cluster_id) AS i, count(*) OVER () AS m
           FROM z WHERE cluster_id NOT IN (SELECT c FROM named))
, names AS (SELECT c AS cluster_id, nm AS segment_name FROM named UNION ALL
            SELECT c, 'Moderate Risk Borrowers' || CASE WHEN m > 1 THEN ' (' || CAST(i AS VARCHAR) || ')' ELSE '' END FROM rest)
"""

O["g18_segment_names"] = with_scored(_NAMES + "SELECT cluster_id, segment_name FROM names")

O["g23_compare_with_supervised"] = with_scored(_NAMES + f"""
, mp AS (SELECT cluster AS cluster_id, avg(p) AS mpp FROM seg GROUP BY cluster)
SELECT prof.cluster_id, coalesce(names.segment_name, 'Cluster ' || CAST(prof.cluster_id AS VARCHAR)) AS segment_name,
  {r('prof.average_default_rate')} AS average_default_rate, {r('mp.mpp')} AS mean_predicted_probability
FROM prof LEFT JOIN names USING (cluster_id) LEFT JOIN mp USING (cluster_id)""")

O["g24_probability_by_cluster"] = with_scored(_SEG + f"""
, two AS (SELECT cluster, 'score_a' AS model, p, default_flag FROM seg UNION ALL
          SELECT cluster, 'score_b', CAST((id * 16807) % 1000 AS DOUBLE) / 1000.0 * 0.5 + default_flag * 0.3, default_flag FROM seg)
SELECT cluster, model, {r('avg(p)')} AS mean_p, {r('stddev_samp(p)')} AS std_p,
  {r('avg(CAST(default_flag AS DOUBLE))')} AS default_rate FROM two GROUP BY cluster, model""")

O["t12_score_correlations"] = with_scored(_SEG + f"""
, w AS (SELECT cluster, default_flag, p AS score_a,
          CAST((id * 16807) % 1000 AS DOUBLE) / 1000.0 * 0.5 + default_flag * 0.3 AS score_b FROM seg)
, cm AS (SELECT cluster, avg(score_a) AS a, avg(score_b) AS b, avg(CAST(default_flag AS DOUBLE)) AS rate FROM w GROUP BY cluster)
SELECT 'rows' AS level, 'score_a' AS var_a, 'score_b' AS var_b, {r('corr(score_a, score_b)')} AS r FROM w
UNION ALL SELECT 'cluster_means', 'score_a', 'score_b', {r('corr(a, b)')} FROM cm
UNION ALL SELECT 'cluster_means', 'score_a', 'default_rate', {r('corr(a, rate)')} FROM cm
UNION ALL SELECT 'cluster_means', 'score_b', 'default_rate', {r('corr(b, rate)')} FROM cm""")

def _x13_default() -> str:
    from lendscope.operators.explain import DEFAULT_INTERACTION_PAIRS, INTERACTION_NUMERIC
    edges = ", ".join(f"{_qbin(c).replace('FROM loans', 'FROM scored')} AS e_{c}" for c in INTERACTION_NUMERIC)
    labels = ", ".join(f"{_qlabel(c, f'e.e_{c}')} AS {c}_bin" for c in INTERACTION_NUMERIC)

    def key(c):
        return f"{c}_bin" if c in INTERACTION_NUMERIC else f"CAST({c} AS VARCHAR)"
    parts = [f"""SELECT {key(a)} AS a_value, {key(b)} AS b_value, {r('avg(p)')} AS mean_score, count(*) AS n,
      {q(a)} AS feature_a, {q(b)} AS feature_b FROM lab WHERE {key(a)} IS NOT NULL AND {key(b)} IS NOT NULL
      GROUP BY {key(a)}, {key(b)}""" for a, b in DEFAULT_INTERACTION_PAIRS]
    return with_scored(f", e AS (SELECT {edges}), lab AS (SELECT scored.*, {labels} FROM scored, e)\n"
                       + "\nUNION ALL\n".join(parts))


O["x13_default_interaction_pairs"] = _x13_default()

O["x13_interaction_table"] = with_scored(f"""
, e AS (SELECT {_qbin('dti').replace('FROM loans', 'FROM scored')} AS e_dti)
, lab AS (SELECT scored.*, {_qlabel('dti', 'e.e_dti')} AS dti_bin FROM scored, e)
SELECT CAST(purpose AS VARCHAR) AS a_value, CAST(grade AS VARCHAR) AS b_value, {r('avg(p)')} AS mean_score, count(*) AS n,
  'purpose' AS feature_a, 'grade' AS feature_b FROM lab WHERE purpose IS NOT NULL AND grade IS NOT NULL GROUP BY purpose, grade
UNION ALL
SELECT CAST(home_ownership AS VARCHAR), dti_bin, {r('avg(p)')}, count(*), 'home_ownership', 'dti' FROM lab
WHERE home_ownership IS NOT NULL AND dti_bin IS NOT NULL GROUP BY home_ownership, dti_bin""")

# ------------------------------------------------------------------ files, rules and round trips
O["io1_csv_round_trip"] = with_raw("SELECT id, term, int_rate, grade, emp_length, loan_status, addr_state FROM loan_raw")

_AUC = """
, long AS (SELECT 'Logistic Regression' AS model, default_flag AS y, CAST(p AS DOUBLE) AS s FROM scored
  UNION ALL SELECT 'Random Forest', default_flag, CAST(int_rate AS DOUBLE) FROM scored
  UNION ALL SELECT 'XGBoost', default_flag, CAST(dti AS DOUBLE) FROM scored)
, rk AS (SELECT model, y, rank() OVER (PARTITION BY model ORDER BY s)
           + (count(*) OVER (PARTITION BY model, s) - 1) / 2.0 AS r FROM long WHERE s IS NOT NULL)
, auc AS (SELECT model, (sum(CASE WHEN y = 1 THEN r ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
           / (sum(y) * sum(1 - y)) AS v FROM rk GROUP BY model)
"""
O["m13_production_model"] = with_scored(_AUC + f"""
SELECT model, {r('v')} AS roc_auc,
  (SELECT CASE model WHEN 'Logistic Regression' THEN 'logistic_regression' WHEN 'Random Forest' THEN 'random_forest'
                     ELSE 'gradient_boosting' END FROM auc ORDER BY v DESC LIMIT 1) AS production_model FROM auc""")

O["t9_vif_two_columns"] = with_loans(f"""
, c AS (SELECT corr(loan_amnt, annual_inc) AS x FROM loans WHERE loan_amnt IS NOT NULL AND annual_inc IS NOT NULL)
SELECT variable, {r('1.0 / (1.0 - x * x)')} AS vif FROM c, (VALUES ('loan_amnt'), ('annual_inc')) AS v(variable)""")

O["p11_policy_violations"] = with_scored("""
, g AS (SELECT grade, quantile_cont(p, 0.25) AS a FROM scored GROUP BY grade)
SELECT grade AS policy_id, 'does_not_cover_1' AS "check", '0.99' AS detail FROM g WHERE grade IN ('A', 'C', 'E')
UNION ALL SELECT grade, 'tier_without_action', 't2' FROM g WHERE grade = 'B'""")
