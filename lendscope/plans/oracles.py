"""Independent DuckDB SQL for every registered query that SQL can express."""

from __future__ import annotations

from lendscope import roles as R
from lendscope.plans.oracles_base import with_loans

ORACLES: dict = {}

NUM = R.NUMERIC_FEATURES


def _r(x: str, digits: int = 8) -> str:
    """8 significant digits, the same rule as ``inputs.sig_round``."""
    from lendscope.plans.oracles_more import r
    return r(x, digits)


def _unpivot_values(cols, alias="value", name="column") -> str:
    return ", ".join(f"('{c}', CAST({c} AS DOUBLE))" for c in cols)


ORACLES["c7_clean_dataset"] = with_loans("SELECT id, addr_state, term, grade, home_ownership, "
    "verification_status, purpose, initial_list_status, application_type, default_flag, "
    + ", ".join(f"{_r(c)} AS {c}" for c in NUM) + " FROM loans")

ORACLES["a1_default_rate_by_grade"] = with_loans("""
SELECT grade, count(default_flag) AS loan_count, CAST(sum(default_flag) AS BIGINT) AS default_count,
  round_even(sum(default_flag) / count(default_flag), 4) AS default_rate
FROM loans WHERE grade IS NOT NULL GROUP BY grade""")

_Z = "1.959963984540054"
ORACLES["a3_default_rate_ci_by_purpose"] = with_loans(f"""
, g AS (SELECT purpose, count(*) AS n, CAST(sum(default_flag) AS BIGINT) AS k
        FROM loans WHERE purpose IS NOT NULL GROUP BY purpose)
, w AS (SELECT *, k / CAST(n AS DOUBLE) AS p,
          1 + {_Z} * {_Z} / CAST(n AS DOUBLE) AS denom FROM g)
, w2 AS (SELECT *, (p + {_Z} * {_Z} / (2 * CAST(n AS DOUBLE))) / denom AS center,
          ({_Z} * sqrt(p * (1 - p) / CAST(n AS DOUBLE) + {_Z} * {_Z} / (4 * CAST(n AS DOUBLE) * CAST(n AS DOUBLE)))) / denom AS half
         FROM w)
SELECT purpose, n AS loan_count, k AS default_count, round_even(p, 4) AS default_rate,
  round_even(greatest(0.0, center - half), 4) AS ci_lower,
  round_even(least(1.0, center + half), 4) AS ci_upper
FROM w2""")

ORACLES["a4_numeric_descriptive_stats"] = with_loans(f"""
, long AS (SELECT u.cname, u.value FROM loans,
    LATERAL (VALUES {_unpivot_values(NUM)}) AS u(cname, value) WHERE u.value IS NOT NULL AND NOT isnan(u.value))
, m AS (SELECT cname, avg(value) AS mean, count(*) AS n FROM long GROUP BY cname)
, mom AS (SELECT l.cname, avg(power(value - mean, 2)) AS m2, avg(power(value - mean, 3)) AS m3,
            avg(power(value - mean, 4)) AS m4 FROM long l JOIN m USING (cname) GROUP BY l.cname)
, s AS (SELECT cname, avg(value) AS mean, stddev_samp(value) AS std_dev, var_samp(value) AS variance,
          min(value) AS min, max(value) AS max, count(*) AS n,
          quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.25) AS q1_25pct,
          quantile_cont(value, 0.75) AS q3_75pct
        FROM long GROUP BY cname)
SELECT s.cname AS variable, {_r("mean")} AS mean, {_r("median")} AS median,
  {_r("std_dev")} AS std_dev, {_r("variance")} AS variance, {_r("min")} AS min,
  {_r("q1_25pct")} AS q1_25pct, {_r("q3_75pct")} AS q3_75pct, {_r("max")} AS max,
  {_r("CASE WHEN m2 = 0 THEN NULL ELSE m3 / power(m2, 1.5) END")} AS skewness,
  {_r("CASE WHEN m2 = 0 THEN NULL ELSE m4 / (m2 * m2) - 3 END")} AS excess_kurtosis, n
FROM s JOIN mom USING (cname)""")


from lendscope.plans.oracles_more import O as _MORE  # noqa: E402

ORACLES.update(_MORE)

from lendscope.plans.oracles_ml import O as _ML  # noqa: E402

ORACLES.update(_ML)

from lendscope.plans.oracles_segments import O as _SEGMENTS  # noqa: E402

ORACLES.update(_SEGMENTS)

# what a version of the store gives back is what was published, a failed version or not
ORACLES["io6_training_artifacts"] = ORACLES["e11_threshold_table"]

# the streaming scorer must produce exactly the batch scoring of the same rows
ORACLES["s1_streaming_policy_scoring"] = ORACLES["p8_batch_scoring"]
# round trips through files must give what was written
ORACLES["io2_table_round_trip"] = ORACLES["c7_clean_dataset"]
ORACLES["io9_winsorize_job"] = ORACLES["c8_winsorize"]
ORACLES["io10_policy_json_scoring"] = ORACLES["p8_batch_scoring"]
ORACLES["p9_single_borrower"] = ORACLES["p8_batch_scoring"].replace(
    "SELECT * FROM sc", "SELECT * FROM sc WHERE id = (SELECT id FROM scored ORDER BY p DESC, id LIMIT 1)")
