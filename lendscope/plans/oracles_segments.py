"""DuckDB oracles for restored engines, artefacts, isotonic curves, rank
correlations and segment tables."""

from __future__ import annotations

from lendscope import roles as R
from lendscope.plans.oracles_base import with_loans, with_scored
from lendscope.plans.oracles_ml import _IMPUTED, _NAMES, _NUM_LONG, _SEG, _scaled
from lendscope.plans.oracles_ml import _TIER as TIER
from lendscope.plans.oracles_more import NUM, _bounds_cte, _clip, q, r

O: dict = {}

# isotonic fit by its min-max form: the largest over starts a <= i of the least mean of a..b over ends b >= i
O["m9_isotonic_fit"] = with_scored(f"""
, c AS (SELECT floor(p * 200) / 200.0 AS s, count(*) AS n, CAST(sum(default_flag) AS DOUBLE) AS t FROM scored GROUP BY 1)
, i AS (SELECT *, row_number() OVER (ORDER BY s) AS i, sum(n) OVER (ORDER BY s) AS cn, sum(t) OVER (ORDER BY s) AS ct FROM c)
, ab AS (SELECT a.i AS a, b.i AS b, (b.ct - a.ct + a.t) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS m FROM i a JOIN i b ON b.i >= a.i)
, least_mean AS (SELECT a, b AS i, min(m) OVER (PARTITION BY a ORDER BY b DESC) AS m FROM ab)
, fit AS (SELECT i, max(m) AS v FROM least_mean GROUP BY i)
SELECT s, CAST(n AS BIGINT) AS n, {r('v')} AS calibrated FROM i JOIN fit USING (i)""".replace("SELECT s, CAST", f"SELECT {r('s')} AS s, CAST"))

_CLIPPED = ", wl AS (SELECT loans.* REPLACE (" + ", ".join(f"{_clip(c)} AS {c}" for c in NUM) + ") FROM loans)"
O["io7_restored_assignment"] = with_loans(
    _bounds_cte(R.WINSOR_IQR_MULTIPLIER) + _CLIPPED + _IMPUTED.replace("FROM loans", "FROM wl")
    + ", gst AS (SELECT avg(g) AS gm, stddev_pop(g) AS gs FROM ordv)"
    + ", fl AS (" + _NUM_LONG + f" UNION ALL SELECT id, 'ordinal_categorical__grade', {_scaled('g', 'gm', 'gs')} FROM ordv, gst)"
    + """
, given AS (SELECT id, CAST(list_position(['A','B','C','D','E','F','G'], grade) - 1 AS INTEGER) AS cluster FROM loans
            WHERE grade IS NOT NULL)
, cen AS (SELECT cluster, feature, avg(value) AS c FROM fl JOIN given USING (id) GROUP BY cluster, feature)
, dist AS (SELECT id, cluster, sum(power(value - c, 2)) AS d FROM fl JOIN cen USING (feature) GROUP BY id, cluster)
SELECT id, cluster AS cluster_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, cluster) AS rn FROM dist)
WHERE rn = 1""")

_PAIRS = ", ".join(f"({q(a)}, {q(b)}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
                   for i, a in enumerate(NUM) for b in NUM[i + 1:])
O["t7_spearman_matrix"] = with_loans(f"""
, pl AS (SELECT u.a, u.b, u.x, u.y FROM loans, LATERAL (VALUES {_PAIRS}) AS u(a, b, x, y)
         WHERE u.x IS NOT NULL AND u.y IS NOT NULL AND NOT isnan(u.x) AND NOT isnan(u.y))
, rk AS (SELECT a, b, rank() OVER (PARTITION BY a, b ORDER BY x) + (count(*) OVER (PARTITION BY a, b, x) - 1) / 2.0 AS x,
                rank() OVER (PARTITION BY a, b ORDER BY y) + (count(*) OVER (PARTITION BY a, b, y) - 1) / 2.0 AS y FROM pl)
, cr AS (SELECT a AS var_a, b AS var_b, corr(x, y) AS r FROM rk GROUP BY a, b)
SELECT var_a, var_b, {r('r')} AS r FROM cr""")

_COMPARISON = _NAMES + f"""
, comp AS (SELECT prof.*, coalesce(names.segment_name, 'Cluster ' || CAST(prof.cluster_id AS VARCHAR)) AS segment_name,
             CASE WHEN average_default_rate IS NOT NULL THEN {TIER} ELSE 'Unknown' END AS risk_tier
           FROM prof LEFT JOIN names USING (cluster_id))
"""
O["g21_segment_comparison"] = with_scored(_COMPARISON + f"""
SELECT cluster_id, segment_name, n_borrowers, {r('pct_of_portfolio')} AS pct_of_portfolio, {r('annual_inc')} AS typical_income,
  {r('int_rate')} AS typical_interest_rate, grade AS typical_loan_grade, {r('dti')} AS typical_dti,
  {r('emp_length_years')} AS typical_employment_length, {r('average_default_rate')} AS average_default_rate, risk_tier,
  {r('loan_amnt')} AS typical_loan_amount, home_ownership AS typical_home_ownership, purpose AS typical_loan_purpose
FROM comp""")
O["g22_riskiest_and_safest"] = with_scored(_COMPARISON + """
SELECT (SELECT segment_name FROM comp ORDER BY coalesce(average_default_rate, int_rate) DESC, cluster_id LIMIT 1) AS riskiest_segment,
       (SELECT segment_name FROM comp ORDER BY coalesce(average_default_rate, int_rate), cluster_id LIMIT 1) AS safest_segment""")

O["g24_probability_rate_correlation"] = with_scored(_SEG + f"""
, two AS (SELECT cluster, 'score_a' AS model, p, default_flag FROM seg UNION ALL
          SELECT cluster, 'score_b', CAST((id * 16807) % 1000 AS DOUBLE) / 1000.0 * 0.5 + default_flag * 0.3, default_flag FROM seg)
, m AS (SELECT cluster, model, {r('avg(p)')} AS mean_p, {r('avg(CAST(default_flag AS DOUBLE))')} AS rate FROM two GROUP BY cluster, model)
, c AS (SELECT model, corr(mean_p, rate) AS v FROM m GROUP BY model)
SELECT model, {r('v')} AS corr_with_default_rate FROM c""")

O["g11_recommend_k_given_table"] = with_scored("""
, t AS (SELECT CAST(list_position(['A','B','C','D','E','F','G'], grade) + 1 AS INTEGER) AS k, avg(p) AS s, avg(loan_amnt) AS c,
          avg(dti) AS d FROM scored GROUP BY 1)
, k AS (SELECT k, rank() OVER (ORDER BY s DESC) + (count(*) OVER (PARTITION BY s) - 1) / 2.0
             + rank() OVER (ORDER BY c DESC) + (count(*) OVER (PARTITION BY c) - 1) / 2.0
             + rank() OVER (ORDER BY d) + (count(*) OVER (PARTITION BY d) - 1) / 2.0 AS total FROM t)
SELECT k AS recommended_k FROM k ORDER BY total, k LIMIT 1""")

O["m16_robustness_given_scores"] = with_scored(f"""
, x AS (SELECT ['train', 'val', 'test'][CAST(id % 3 + 1 AS INTEGER)] AS split, default_flag AS y, p FROM scored)
, k AS (SELECT split, y, rank() OVER (PARTITION BY split ORDER BY p) + (count(*) OVER (PARTITION BY split, p) - 1) / 2.0 AS r FROM x)
, a AS (SELECT split, (sum(CASE WHEN y = 1 THEN r ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y)) AS v
        FROM k GROUP BY split)
, w AS (SELECT max(v) FILTER (WHERE split = 'train') AS train, max(v) FILTER (WHERE split = 'val') AS val,
          max(v) FILTER (WHERE split = 'test') AS test FROM a)
SELECT {r('train')} AS train, {r('val')} AS val, {r('test')} AS test, {r('train - test')} AS train_test_gap FROM w""")

O["g4_density_clusters"] = """
WITH RECURSIVE p AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
near AS (SELECT a.vec_id AS u, b.vec_id AS v, list_distance(a.v, b.v) AS d FROM p a, p b WHERE list_distance(a.v, b.v) <= 1.15),
core AS (SELECT u FROM near GROUP BY u HAVING count(*) >= 4),
links AS (SELECT u, v FROM near WHERE u IN (SELECT u FROM core) AND v IN (SELECT u FROM core)),
reach(u, v) AS (SELECT u, u FROM core UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
root AS (SELECT u, min(v) AS root FROM reach GROUP BY u),
border AS (SELECT n.u, arg_min(n.v, struct_pack(d := n.d, v := n.v)) AS at FROM near n
           WHERE n.v IN (SELECT u FROM core) AND n.u NOT IN (SELECT u FROM core) GROUP BY n.u),
member AS (SELECT u, root FROM root UNION ALL SELECT b.u, r.root FROM border b JOIN root r ON r.u = b.at),
least AS (SELECT root, min(u) AS least FROM member GROUP BY root),
number AS (SELECT root, CAST(row_number() OVER (ORDER BY least) - 1 AS INTEGER) AS cluster FROM least)
SELECT p.vec_id, coalesce(number.cluster, -1) AS cluster, p.vec_id IN (SELECT u FROM core) AS is_core
FROM p LEFT JOIN member ON member.u = p.vec_id LEFT JOIN number ON number.root = member.root"""

O["x14_ice_given_model"] = with_loans(f"""
, g AS (SELECT unnest([2.0, 5.0, 8.0, 11.0])::DOUBLE AS grid_value)
SELECT id, grid_value, {r('1.0 / (1.0 + exp(-(-2.0 + 0.02 * dti + 0.09 * grid_value)))')} AS p
FROM loans, g WHERE int_rate IS NOT NULL AND dti IS NOT NULL""")

O["b3_policy_per_grade"] = with_scored("""
, e AS (SELECT grade, quantile_cont(p, 0.25) AS a, quantile_cont(p, 0.5) AS b, quantile_cont(p, 0.75) AS c FROM scored GROUP BY grade)
SELECT id, grade, CASE WHEN p >= 0 AND p < a THEN 't1' WHEN p >= a AND p < b THEN 't2' WHEN p >= b AND p < c THEN 't3'
                       ELSE 't4' END AS risk_tier FROM scored JOIN e USING (grade)""")

O["a12_median_by_cluster"] = with_loans("SELECT grade, " + ", ".join(
    f"{r(f'quantile_cont({c}, 0.5)')} AS {c}" for c in ("loan_amnt", "int_rate", "dti")) + " FROM loans GROUP BY grade")
