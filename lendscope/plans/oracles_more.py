"""DuckDB oracles for the quality, cleaning, banding, descriptive, test,
evaluation, fairness and policy queries."""

from __future__ import annotations

from lendscope import roles as R
from lendscope.functions import text as TX
from lendscope.plans.oracles_base import with_loans, with_raw, with_scored

O: dict = {}
NUM = R.NUMERIC_FEATURES
Z = "1.959963984540054"

RAW_COLS = ["id", "member_id", "loan_amnt", "term", "int_rate", "installment", "grade", "emp_length",
            "home_ownership", "annual_inc", "verification_status", "loan_status", "purpose", "addr_state",
            "dti", "delinq_2yrs", "open_acc", "pub_rec", "revol_bal", "revol_util", "total_acc",
            "mort_acc", "pub_rec_bankruptcies", "initial_list_status", "application_type"]
LOAN_COLS = (["id", "addr_state"] + NUM + R.ONEHOT_FEATURES + ["grade", "default_flag"])


def r(x: str, digits: int = 8) -> str:
    """8 significant digits, the same IEEE steps as ``inputs.sig_round``."""
    x = f"CAST({x} AS DOUBLE)"
    ex = f"floor(log10(abs({x})))"
    up = f"power(10.0, {ex})"
    down = f"power(10.0, -{ex})"
    k = repr(float(10 ** (digits - 1)))
    return (f"(CASE WHEN ({x}) IS NULL OR ({x}) = 0 OR isnan({x}) OR isinf({x}) THEN ({x}) "
            f"WHEN {ex} >= 0 THEN floor(({x}) / {up} * CAST({k} AS DOUBLE) + 0.5) / CAST({k} AS DOUBLE) * {up} "
            f"ELSE floor(({x}) * {down} * CAST({k} AS DOUBLE) + 0.5) / CAST({k} AS DOUBLE) / {down} END)")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ------------------------------------------------------------------ quality
def _missing_union(table: str, cols) -> str:
    parts = [f"SELECT {q(c)} AS cname, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, count(*) AS n FROM {table}"
             for c in cols]
    return " UNION ALL ".join(parts)


O["dq2_missing_summary"] = with_raw(f"""
, m AS ({_missing_union('loan_raw', RAW_COLS)})
SELECT cname AS "column", missing_count, round_even(missing_count / n * 100, 2) AS missing_pct
FROM m WHERE missing_count > 0""")

O["dq3_duplicate_rows"] = with_raw(f"""
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_row_count
FROM (SELECT count(*) AS n FROM loan_raw GROUP BY {', '.join(RAW_COLS)})""")

O["dq3_duplicate_documents"] = """
SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_row_count
FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source)"""

_RULES = """
SELECT 'negative_or_zero_loan_amnt' AS "check", count(*) FILTER (WHERE loan_amnt <= 0) AS value FROM loan_raw
UNION ALL SELECT 'negative_annual_inc', count(*) FILTER (WHERE annual_inc < 0) FROM loan_raw
UNION ALL SELECT 'loan_status_out_of_scope_rows',
  count(*) FILTER (WHERE NOT coalesce(loan_status IN ('Fully Paid', 'Charged Off', 'Default'), false)) FROM loan_raw
UNION ALL SELECT 'rows_outside_target_state', count(*) FILTER (WHERE addr_state IS DISTINCT FROM 'IN') FROM loan_raw"""

O["dq5_business_rules"] = with_raw(_RULES)

_DRIFT = [c for c in R.EXPECTED_RAW_COLUMNS if c not in RAW_COLS]
O["dq6_validate_dataset"] = with_raw(f"""
, m AS ({_missing_union('loan_raw', RAW_COLS)})
, rules AS ({_RULES})
SELECT 'shape' AS section, 'n_rows' AS item, CAST(count(*) AS DOUBLE) AS value FROM loan_raw
UNION ALL SELECT 'shape', 'n_columns', {float(len(RAW_COLS))}
""" + "".join(f"UNION ALL SELECT 'missing_column', {q(c)}, 1.0\n" for c in _DRIFT) + f"""
UNION ALL SELECT 'missing_count', cname, CAST(missing_count AS DOUBLE) FROM m WHERE missing_count > 0
UNION ALL SELECT 'duplicates', 'duplicate_row_count', CAST(coalesce(sum(n - 1), 0) AS DOUBLE)
  FROM (SELECT count(*) AS n FROM loan_raw GROUP BY {', '.join(RAW_COLS)})
UNION ALL SELECT 'invalid_values', "check", CAST(value AS DOUBLE) FROM rules""")

O["dq7_dataset_overview"] = with_loans(f"""
, m AS ({_missing_union('loans', LOAN_COLS)})
SELECT 'n_rows' AS item, CAST(count(*) AS DOUBLE) AS value FROM loans
UNION ALL SELECT 'n_columns', {float(len(LOAN_COLS))}
UNION ALL SELECT 'n_columns_with_missing', CAST(count(*) AS DOUBLE) FROM m WHERE missing_count > 0
UNION ALL SELECT 'duplicate_row_count', CAST(coalesce(sum(n - 1), 0) AS DOUBLE)
  FROM (SELECT count(*) AS n FROM loans GROUP BY {', '.join(LOAN_COLS)})
UNION ALL SELECT 'target_share_' || CAST(default_flag AS VARCHAR),
  round_even(count(*) / sum(count(*)) OVER (), 4) FROM loans GROUP BY default_flag""")

LOAN_BOOK_COLUMNS = """id member_id loan_amnt term int_rate installment grade emp_length home_ownership annual_inc
verification_status loan_status purpose addr_state dti delinq_2yrs open_acc pub_rec revol_bal revol_util total_acc mort_acc
pub_rec_bankruptcies initial_list_status application_type""".split()
O["dq9_missing_matrix"] = with_raw("""
SELECT id, """ + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}" for c in LOAN_BOOK_COLUMNS if c != "id") + " FROM loan_raw")

# ------------------------------------------------------------------ cleaning
O["c1_filter_to_state"] = with_raw("SELECT id, addr_state, loan_status FROM loan_raw WHERE addr_state = 'NATION_17'")
O["c2_remove_duplicates"] = "SELECT DISTINCT doc_id, text, lang, source, n_chars FROM documents"


def _pct(c: str) -> str:
    x = f"TRY_CAST(replace(replace(trim(CAST({c} AS VARCHAR)), '%', ''), 'nan', '') AS DOUBLE)"
    return f"(CASE WHEN isnan({x}) THEN NULL ELSE {x} END)"


O["c3_parse_percentages"] = with_raw(
    f"SELECT id, {r(_pct('int_rate'))} AS int_rate, {r(_pct('revol_util'))} AS revol_util FROM loan_raw")

_EMP = "CASE trim(emp_length) " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in R.EMP_LENGTH_MAP.items()) + " END"
O["c4_parse_emp_length"] = with_raw(f"SELECT id, CAST({_EMP} AS DOUBLE) AS emp_length_years FROM loan_raw")
O["c5_create_target"] = with_raw("""
SELECT id, CAST(CASE loan_status WHEN 'Fully Paid' THEN 0 WHEN 'Charged Off' THEN 1 WHEN 'Default' THEN 1 END
  AS INTEGER) AS default_flag FROM loan_raw WHERE loan_status IN ('Fully Paid', 'Charged Off', 'Default')""")


def _bounds_cte(k: float) -> str:
    sel = " UNION ALL ".join(
        f"SELECT {q(c)} AS cname, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM loans"
        for c in NUM)
    return (f", qs AS ({sel})\n, bnd AS (SELECT cname, q1 - {k} * (q3 - q1) AS lo, q3 + {k} * (q3 - q1) AS hi FROM qs)")


def _clip(c: str) -> str:
    lo = f"(SELECT lo FROM bnd WHERE cname = {q(c)})"
    hi = f"(SELECT hi FROM bnd WHERE cname = {q(c)})"
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE least(greatest({c}, {lo}), {hi}) END"


O["c8_winsorize"] = with_loans(_bounds_cte(3.0) + "\nSELECT id, " +
                               ", ".join(f"{r(_clip(c))} AS {c}" for c in NUM) + " FROM loans")

O["c9_clip_counts"] = with_loans(_bounds_cte(1.5) + "\n" + " UNION ALL ".join(
    f"""SELECT {q(c)} AS "column", {r('b.lo')} AS lower_bound, {r('b.hi')} AS upper_bound,
      count(*) FILTER (WHERE {c} < b.lo) AS n_clipped_low, count(*) FILTER (WHERE {c} > b.hi) AS n_clipped_high,
      count(*) FILTER (WHERE {c} < b.lo) + count(*) FILTER (WHERE {c} > b.hi) AS n_clipped
    FROM loans, bnd b WHERE b.cname = {q(c)} GROUP BY b.lo, b.hi""" for c in NUM))

O["c10_borrower_filters"] = with_loans(f"""
SELECT id, grade, purpose, {r('loan_amnt')} AS loan_amnt, {r('annual_inc')} AS annual_inc, {r('dti')} AS dti
FROM loans WHERE grade IN ('A', 'B', 'C') AND purpose IN ('BUILDING', 'MACHINERY')
  AND loan_amnt BETWEEN 10000.0 AND 40000.0 AND annual_inc BETWEEN 0.0 AND 80000.0 AND dti BETWEEN 5.0 AND 45.0""")

O["c11_filter_domains"] = with_loans(" UNION ALL ".join(
    f"""SELECT {q(c)} AS "column", 'range' AS kind, {r(f'min({c})')} AS min_value, {r(f'max({c})')} AS max_value,
       CAST(NULL AS VARCHAR) AS category FROM loans""" for c in ["loan_amnt", "annual_inc", "dti", "int_rate"]) +
    " UNION ALL " + " UNION ALL ".join(
    f"""SELECT DISTINCT {q(c)}, 'domain', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST({c} AS VARCHAR)
       FROM loans WHERE {c} IS NOT NULL""" for c in ["grade", "purpose", "home_ownership"]))

_LITTLE = ", ".join(q(w) for w in TX.LITTLE_WORDS)


def title_sql(x: str) -> str:
    words = f"list_filter(string_split_regex(trim(replace(CAST({x} AS VARCHAR), '_', ' ')), '\\s+'), lambda w: w <> '')"
    return (f"array_to_string(list_transform({words}, lambda w, i: CASE WHEN i > 1 AND lower(w) IN ({_LITTLE}) "
            f"THEN lower(w) ELSE upper(substr(w, 1, 1)) || lower(substr(w, 2)) END), ' ')")


def cat_label_sql(col: str, x: str) -> str:
    m = TX.CATEGORY_LABELS.get(col, {})
    key = f"trim(CAST({x} AS VARCHAR))"
    if not m:
        return title_sql(key)
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in m.items())
    return f"coalesce(CASE {key} {cases} END, {title_sql(key)})"


O["c12_category_labels"] = with_loans(f"""
SELECT id, {cat_label_sql('term', 'term')} AS term_label, {cat_label_sql('purpose', 'purpose')} AS purpose_label,
  {cat_label_sql('home_ownership', 'home_ownership')} AS home_label,
  {cat_label_sql('initial_list_status', 'initial_list_status')} AS list_label FROM loans""")

_FEATS = (", feats AS (" + " UNION ".join(
    f"SELECT DISTINCT 'onehot_categorical__{c}_' || {c} AS feature FROM loans WHERE {c} IS NOT NULL"
    for c in R.ONEHOT_FEATURES) + " UNION ALL " + " UNION ALL ".join(
    f"SELECT 'numeric__{c}'" for c in NUM) + " UNION ALL SELECT 'ordinal_categorical__grade')"
    ", fr AS (SELECT feature, regexp_replace(feature, '^(onehot_categorical__|ordinal_categorical__|numeric__)', '')"
    " AS rem FROM feats)")


def _py_title(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


def _humanize() -> str:
    bases = sorted(R.ONEHOT_FEATURES, key=len, reverse=True)
    cases = []
    for b in bases:
        lab = TX.FEATURE_LABELS.get(b)
        cat = f"trim(replace(substr(rem, {len(b) + 2}), '_', ' '))"
        cases.append(f"WHEN starts_with(feature, 'onehot_categorical__') AND starts_with(rem, {q(b + '_')}) "
                     f"THEN {q(lab + ': ')} || {_py_title(cat)}")
    fl = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in TX.FEATURE_LABELS.items())
    fallback = f"coalesce(CASE rem {fl} END, upper(substr(trim(replace(rem, '_', ' ')), 1, 1)) || lower(substr(trim(replace(rem, '_', ' ')), 2)))"
    return "CASE " + " ".join(cases) + f" ELSE {fallback} END"


O["c13_humanize_feature_names"] = with_loans(_FEATS + f"\nSELECT feature, {_humanize()} AS feature_label FROM fr")
O["c14_research_question_links"] = with_loans(_FEATS + "\nSELECT feature, CASE " + " ".join(
    f"WHEN rem = {q(raw)} OR starts_with(rem, {q(raw + '_')}) THEN {q(txt)}" for raw, txt in TX.RESEARCH_QUESTIONS.items())
    + " ELSE NULL END AS research_question FROM fr")


def _mode_sql(c: str) -> str:
    return (f"(SELECT CAST({c} AS VARCHAR) FROM loans WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, CAST({c} AS VARCHAR) ASC LIMIT 1)")


O["c16_form_defaults"] = with_loans(" UNION ALL ".join(
    f"""SELECT {q(c)} AS "column", {r(f'quantile_cont({c}, 0.5)')} AS median_value, CAST(NULL AS VARCHAR) AS mode_value
       FROM loans""" for c in ["loan_amnt", "annual_inc", "dti", "int_rate"]) + " UNION ALL " + " UNION ALL ".join(
    f"SELECT {q(c)}, CAST(NULL AS DOUBLE), {_mode_sql(c)}" for c in ["grade", "purpose", "home_ownership", "term"]))


# ------------------------------------------------------------------ banding
def _qbin(c: str, qn: int = 4) -> str:
    probs = ", ".join(str(i / qn) for i in range(qn + 1))
    return (f"(SELECT list_sort(list_distinct(quantile_cont({c}, [{probs}]))) FROM loans)")


def _qlabel(c: str, edges: str) -> str:
    inner = f"{edges}[2:len({edges}) - 1]"
    return (f"CASE WHEN {c} IS NULL OR len({edges}) < 2 OR {c} < {edges}[1] OR {c} > {edges}[len({edges})] THEN NULL "
            f"ELSE 'Q' || CAST(1 + len(list_filter({inner}, lambda e: e < {c})) AS VARCHAR) END")


def _rate_by(col: str, src: str, extra: str = "") -> str:
    return (f"SELECT {col} AS bin, count(default_flag) AS loan_count, CAST(sum(default_flag) AS BIGINT) AS default_count, "
            f"round_even(sum(default_flag) / count(default_flag), 4) AS default_rate{extra} "
            f"FROM {src} WHERE {col} IS NOT NULL GROUP BY {col}")


O["b1_quartile_bins"] = with_loans(f"""
, e AS (SELECT {_qbin('annual_inc')} AS e_inc, {_qbin('int_rate')} AS e_rate)
, lab AS (SELECT loans.*, {_qlabel('annual_inc', 'e.e_inc')} AS income_quartile,
            {_qlabel('int_rate', 'e.e_rate')} AS rate_quartile FROM loans, e)
{_rate_by('income_quartile', 'lab', ", 'income' AS band")}
UNION ALL {_rate_by('rate_quartile', 'lab', ", 'rate' AS band")}""")

O["b2_fixed_bands"] = with_loans("""
, lab AS (SELECT *, CASE WHEN dti >= 0 AND dti <= 10 THEN '0-10' WHEN dti > 10 AND dti <= 20 THEN '10-20'
    WHEN dti > 20 AND dti <= 30 THEN '20-30' WHEN dti > 30 AND dti <= 40 THEN '30-40'
    WHEN dti > 40 AND dti <= 60 THEN '40+' END AS dti_band FROM loans)
SELECT dti_band, count(default_flag) AS loan_count, CAST(sum(default_flag) AS BIGINT) AS default_count,
  round_even(sum(default_flag) / count(default_flag), 4) AS default_rate
FROM lab WHERE dti_band IS NOT NULL GROUP BY dti_band""")


def band_sql(p: str, bands) -> str:
    cases = " ".join(f"WHEN {p} >= {float(b[1])} AND {p} < {float(b[2])} THEN {q(b[0])}" for b in bands)
    return f"CASE {cases} ELSE {q(bands[-1][0])} END"


TIER = band_sql("p", R.RISK_TIERS)
GRADE = band_sql("p", R.LOAN_GRADE_BANDS)
O["b3_policy_bands"] = with_scored(f"SELECT id, {TIER} AS risk_tier, {GRADE} AS model_loan_grade FROM scored")

# ------------------------------------------------------------------ descriptive
O["a2_default_rate_summary"] = with_loans(f"""
SELECT grade, count(default_flag) AS loan_count, CAST(sum(default_flag) AS BIGINT) AS default_count,
  {r('round_even(sum(default_flag) / count(default_flag), 4)')} AS default_rate,
  (SELECT {r('avg(CAST(default_flag AS DOUBLE))')} FROM loans) AS portfolio_rate,
  count(default_flag) >= 5 AS in_plot,
  CAST(list_position(['A','B','C','D','E','F','G'], grade) - 1 AS BIGINT) AS sort_index
FROM loans WHERE grade IS NOT NULL GROUP BY grade""")

O["a5_frequency_table"] = with_loans("""
SELECT emp_length_years, count(*) AS count, round_even(count(*) / sum(count(*)) OVER () * 100, 2) AS percentage
FROM loans GROUP BY emp_length_years""")

_SKEW = "CASE WHEN m2 = 0 THEN NULL ELSE m3 / power(m2, 1.5) END"
_KURT = "CASE WHEN m2 = 0 THEN NULL ELSE m4 / (m2 * m2) - 3 END"
_LONG = ("long AS (SELECT u.cname, u.value FROM loans, LATERAL (VALUES " +
         ", ".join(f"({q(c)}, CAST({c} AS DOUBLE))" for c in NUM) +
         ") AS u(cname, value) WHERE u.value IS NOT NULL)")
O["a6_skew_kurtosis_verdicts"] = with_loans(f"""
, {_LONG}
, m AS (SELECT cname, avg(value) AS mean FROM long GROUP BY cname)
, mom AS (SELECT l.cname, avg(power(value - mean, 2)) AS m2, avg(power(value - mean, 3)) AS m3,
            avg(power(value - mean, 4)) AS m4 FROM long l JOIN m USING (cname) GROUP BY l.cname)
, sk AS (SELECT cname, {_SKEW} AS s, {_KURT} AS k FROM mom)
SELECT cname AS variable, 'Distribution is ' ||
  CASE WHEN s > 1 THEN 'strongly right-skewed (a long tail of high values)' WHEN s > 0.5 THEN 'moderately right-skewed'
       WHEN s < -1 THEN 'strongly left-skewed (a long tail of low values)' WHEN s < -0.5 THEN 'moderately left-skewed'
       ELSE 'roughly symmetric' END || ' and ' ||
  CASE WHEN k > 1 THEN 'heavier-tailed than normal (more outlier risk)'
       WHEN k < -1 THEN 'lighter-tailed than normal (fewer extreme values)' ELSE 'close to normal-tailed' END
  || '.' AS interpretation FROM sk""")

O["a7_portfolio_kpis"] = with_loans(f"""
SELECT count(*) AS n_loans, {r('avg(CAST(default_flag AS DOUBLE))')} AS default_rate,
  {r('avg(annual_inc)')} AS mean_annual_inc, {r('avg(loan_amnt)')} AS mean_loan_amnt,
  {r('avg(int_rate)')} AS mean_int_rate, {r('avg(dti)')} AS mean_dti,
  {r('avg(emp_length_years)')} AS mean_emp_length_years
FROM loans WHERE grade IN ('A', 'B', 'C', 'D')""")

O["a8_category_distribution"] = with_loans(
    "SELECT purpose, count(*) AS count FROM loans WHERE purpose IS NOT NULL GROUP BY purpose")

O["a9_riskiest_group"] = with_loans("""
, g AS (SELECT addr_state, round_even(sum(default_flag) / count(default_flag), 4) AS rate
        FROM loans WHERE addr_state IS NOT NULL GROUP BY addr_state)
SELECT addr_state AS riskiest_group, rate AS riskiest_rate FROM g ORDER BY rate DESC, addr_state ASC LIMIT 1""")

_CATS = R.ONEHOT_FEATURES + ["grade"]
O["a10_categorical_spread"] = with_loans(f"""
, long AS (SELECT u.variable, u.value, default_flag FROM loans,
   LATERAL (VALUES {", ".join(f"({q(c)}, CAST({c} AS VARCHAR))" for c in _CATS)}) AS u(variable, value)
   WHERE u.value IS NOT NULL)
, rates AS (SELECT variable, value, avg(CAST(default_flag AS DOUBLE)) AS rate FROM long GROUP BY variable, value)
SELECT variable, {r('max(rate) - min(rate)')} AS rate_spread, count(*) AS n_categories FROM rates GROUP BY variable""")

O["a11_target_balance"] = with_loans("""
SELECT default_flag, count(*) AS count, round_even(count(*) / sum(count(*)) OVER (), 4) AS share
FROM loans GROUP BY default_flag""")

_EMB = ("WITH emb AS (SELECT vec_id, label AS cluster, " +
        ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS e{i}" for i in range(64)) + " FROM embeddings)\n")
O["a12_feature_by_cluster"] = _EMB + "SELECT cluster, " + ", ".join(
    f"{r(f'avg(e{i})')} AS e{i}" for i in range(64)) + " FROM emb GROUP BY cluster"
O["a13_cluster_sizes"] = _EMB + f"SELECT cluster, count(*) AS n, {r('count(*) / sum(count(*)) OVER ()')} AS share FROM emb GROUP BY cluster"
O["a14_cluster_zscore_profile"] = _EMB + """
, means AS (SELECT cluster, """ + ", ".join(f"avg(e{i}) AS e{i}" for i in range(64)) + """ FROM emb GROUP BY cluster)
, long AS (SELECT cluster, u.feature, u.mean FROM means,
   LATERAL (VALUES """ + ", ".join(f"('e{i}', e{i})" for i in range(64)) + """) AS u(feature, mean))
, z AS (SELECT *, avg(mean) OVER (PARTITION BY feature) AS mu, stddev_pop(mean) OVER (PARTITION BY feature) AS sd FROM long)
SELECT cluster, feature, """ + r("mean") + " AS mean, " + r("CASE WHEN sd > 0 THEN (mean - mu) / sd END") + " AS zscore FROM z"


def _hist(src: str, col: str, bins: int, by: str | None = None) -> str:
    keys = f"{by}, " if by else ""
    return f"""
, rng AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {src})
, b AS (SELECT {keys}CAST(CASE WHEN hi > lo THEN least(floor(({col} - lo) / ((hi - lo) / {bins})), {bins - 1}) ELSE 0 END AS INTEGER) AS bin,
          lo, hi FROM {src}, rng WHERE {col} IS NOT NULL)
SELECT {keys}bin, {r(f'lo + bin * ((hi - lo) / {bins})')} AS bin_start, {r(f'lo + (bin + 1) * ((hi - lo) / {bins})')} AS bin_end,
  count(*) AS count FROM b GROUP BY {keys}bin, lo, hi"""


O["a15_histogram"] = "WITH ev AS (SELECT * FROM events)" + _hist("ev", "value", 40)
O["a15_histogram_by_outcome"] = with_loans(_hist("loans", "int_rate", 30, by="default_flag"))

O["a15_score_density_by_outcome"] = with_scored(f"""
, rng AS (SELECT default_flag, min(p) AS lo, max(p) AS hi, count(*) AS n FROM scored WHERE p IS NOT NULL GROUP BY default_flag)
, b AS (SELECT s.default_flag, CAST(CASE WHEN hi > lo THEN least(floor((p - lo) / ((hi - lo) / 30)), 29) ELSE 0 END AS INTEGER) AS bin,
          lo, hi, n FROM scored s JOIN rng USING (default_flag) WHERE p IS NOT NULL)
SELECT default_flag, bin, {r('lo + bin * ((hi - lo) / 30)')} AS bin_start, {r('lo + (bin + 1) * ((hi - lo) / 30)')} AS bin_end,
  count(*) AS count, {r('CASE WHEN (hi - lo) / 30 > 0 THEN count(*) / (n * ((hi - lo) / 30)) END')} AS density
FROM b GROUP BY default_flag, bin, lo, hi, n""")

O["a16_box_stats_by_group"] = f"""
WITH ev AS (SELECT event_type, CAST(value AS DOUBLE) AS value FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL)
, q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
          quantile_cont(value, 0.75) AS q3 FROM ev GROUP BY event_type)
, f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lf, q3 + 1.5 * (q3 - q1) AS uf FROM q)
SELECT ev.event_type, 'value' AS "column", {r('f.q1')} AS q1, {r('f.median')} AS median, {r('f.q3')} AS q3,
  {r('min(value) FILTER (WHERE value >= lf AND value <= uf)')} AS whisker_low,
  {r('max(value) FILTER (WHERE value >= lf AND value <= uf)')} AS whisker_high,
  count(*) FILTER (WHERE NOT (value >= lf AND value <= uf)) AS n_outliers, count(*) AS n
FROM ev JOIN f USING (event_type) GROUP BY ev.event_type, f.q1, f.median, f.q3"""


def _cell(v: str, lo: str, hi: str, g: int) -> str:
    return f"CAST(CASE WHEN {hi} > {lo} THEN least(floor(({v} - {lo}) / (({hi} - {lo}) / {g})), {g - 1}) ELSE 0 END AS INTEGER)"


O["a17_density_2d"] = with_loans(f"""
, rng AS (SELECT min(int_rate) AS x0, max(int_rate) AS x1, min(dti) AS y0, max(dti) AS y1 FROM loans)
SELECT bin_x, bin_y, count(*) AS count FROM (
  SELECT {_cell('int_rate', 'x0', 'x1', 20)} AS bin_x, {_cell('dti', 'y0', 'y1', 20)} AS bin_y
  FROM loans, rng WHERE int_rate IS NOT NULL AND dti IS NOT NULL) GROUP BY bin_x, bin_y""")

O["a18_kde_curve"] = f"""
WITH ev AS (SELECT event_type, value FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL)
, st AS (SELECT event_type, min(value) AS lo, max(value) AS hi, stddev_samp(value) AS sd, count(*) AS n FROM ev GROUP BY event_type)
, hb AS (SELECT ev.event_type, lo, hi, sd, n,
           CASE WHEN hi > lo THEN least(floor((value - lo) / ((hi - lo) / 128)), 127) ELSE 0 END AS b FROM ev JOIN st USING (event_type))
, hist AS (SELECT event_type, b, lo, hi, sd, n, count(*) AS c, lo + (b + 0.5) * ((hi - lo) / 128) AS x FROM hb
           GROUP BY event_type, b, lo, hi, sd, n)
, pts AS (SELECT event_type, x, c, lo, hi, sd, n, gi, lo + (hi - lo) * gi / 49 AS gx, sd * power(n, -0.2) AS h
          FROM hist, range(0, 50) AS t(gi))
SELECT event_type, CAST(gi AS INTEGER) AS gi, {r('gx')} AS x,
  {r('sum(c * exp(-0.5 * power((gx - x) / h, 2)) / (h * sqrt(2 * 3.141592653589793))) / n')} AS density
FROM pts GROUP BY event_type, gi, gx, n"""

# ------------------------------------------------------------------ tests
TT = ["loan_amnt", "int_rate", "annual_inc", "dti", "revol_util", "emp_length_years"]
CHI = ["term", "home_ownership", "verification_status", "purpose", "initial_list_status", "application_type", "grade"]
PAIRS = [("int_rate", "dti"), ("loan_amnt", "installment"), ("annual_inc", "loan_amnt"),
         ("revol_util", "int_rate"), ("open_acc", "total_acc")]


def _long_sql(cols, keep: str) -> str:
    return ("SELECT " + keep + ", u.cname, u.value FROM loans, LATERAL (VALUES " +
            ", ".join(f"({q(c)}, CAST({c} AS DOUBLE))" for c in cols) + ") AS u(cname, value) WHERE u.value IS NOT NULL")


O["t2_welch_t_tests"] = with_loans(f"""
, long AS ({_long_sql(TT, 'default_flag')} AND default_flag IN (0, 1))
, s AS (SELECT cname, count(*) FILTER (WHERE default_flag = 0) AS n_a, avg(value) FILTER (WHERE default_flag = 0) AS mean_a,
          var_samp(value) FILTER (WHERE default_flag = 0) AS var_a, count(*) FILTER (WHERE default_flag = 1) AS n_b,
          avg(value) FILTER (WHERE default_flag = 1) AS mean_b, var_samp(value) FILTER (WHERE default_flag = 1) AS var_b
        FROM long GROUP BY cname)
, s2 AS (SELECT *, var_a / CAST(n_a AS DOUBLE) + var_b / CAST(n_b AS DOUBLE) AS se2,
           sqrt(((n_a - 1.0) * var_a + (n_b - 1.0) * var_b) / (CAST(n_a AS DOUBLE) + n_b - 2)) AS pooled FROM s)
SELECT 'welch_t' AS test, cname AS var_a, 'default_flag' AS var_b, n_a, n_b, {r('mean_a')} AS mean_a, {r('mean_b')} AS mean_b,
  {r('(mean_a - mean_b) / sqrt(se2)')} AS statistic,
  {r('se2 * se2 / (power(var_a / CAST(n_a AS DOUBLE), 2) / (n_a - 1.0) + power(var_b / CAST(n_b AS DOUBLE), 2) / (n_b - 1.0))')} AS df1,
  CAST(NULL AS DOUBLE) AS df2, {r('CASE WHEN pooled > 0 THEN (mean_a - mean_b) / pooled END')} AS effect_size,
  'Cohen''s d' AS effect_label FROM s2""")


def _anova(src_cte: str, cols, group: str) -> str:
    return f"""{src_cte}
, g AS (SELECT cname, {group} AS grp, count(*) AS n, avg(value) AS mean, var_pop(value) * count(*) AS m2
        FROM long WHERE {group} IS NOT NULL GROUP BY cname, {group})
, ga AS (SELECT cname, avg(value) AS grand_all FROM long GROUP BY cname)
, gk AS (SELECT g.*, grand_all FROM g JOIN ga USING (cname) WHERE n > 1)
, gr AS (SELECT cname, sum(n * mean) / sum(n) AS grand_r FROM gk GROUP BY cname)
, a AS (SELECT cname, count(*) AS k, sum(n) AS nn, sum(m2) AS ssw, sum(n * power(mean - grand_all, 2)) AS ssb_all,
          sum(n * power(mean - grand_r, 2)) AS ssb FROM gk JOIN gr USING (cname) GROUP BY cname)
SELECT 'anova' AS test, cname AS var_a, {q(group)} AS var_b, CAST(k AS BIGINT) AS n_groups, CAST(nn AS BIGINT) AS n,
  {r('CASE WHEN k > 1 AND nn > k THEN (ssb / (k - 1.0)) / (ssw / (CAST(nn AS DOUBLE) - k)) END')} AS statistic,
  {r('CAST(k AS DOUBLE) - 1')} AS df1, {r('CAST(nn AS DOUBLE) - k')} AS df2,
  {r('CASE WHEN ssw + ssb_all > 0 THEN ssb_all / (ssw + ssb_all) END')} AS effect_size, 'eta-squared' AS effect_label
FROM a"""


O["t3_anova_by_grade"] = with_loans(_anova(f", long AS ({_long_sql(['loan_amnt', 'int_rate'], 'grade')})",
                                           ['loan_amnt', 'int_rate'], "grade"))
O["t3_anova_doc_length_by_lang"] = "WITH " + _anova(
    "long AS (SELECT lang, 'n_chars' AS cname, CAST(n_chars AS DOUBLE) AS value FROM documents WHERE n_chars IS NOT NULL)",
    ["n_chars"], "lang")


def _chi(long_cte: str, other: str) -> str:
    return f"""{long_cte}
, obs AS (SELECT cname, a, b, count(*) AS o FROM long GROUP BY cname, a, b)
, ra AS (SELECT cname, a, sum(o) AS ra FROM obs GROUP BY cname, a)
, cb AS (SELECT cname, b, sum(o) AS cb FROM obs GROUP BY cname, b)
, grid AS (SELECT ra.cname, ra.a, cb.b, ra.ra, cb.cb, coalesce(obs.o, 0) AS o FROM ra JOIN cb USING (cname)
           LEFT JOIN obs ON obs.cname = ra.cname AND obs.a = ra.a AND obs.b = cb.b)
, dims AS (SELECT cname, count(DISTINCT a) AS rr, count(DISTINCT b) AS kk, sum(o) AS n FROM grid GROUP BY cname)
, cells AS (SELECT grid.*, rr, kk, n, ra * cb / CAST(n AS DOUBLE) AS e FROM grid JOIN dims USING (cname))
, chi AS (SELECT cname, rr, kk, n, sum(power(abs(o - e) - CASE WHEN (rr - 1) * (kk - 1) = 1 THEN least(0.5, abs(o - e)) ELSE 0 END, 2) / e) AS chi2
          FROM cells GROUP BY cname, rr, kk, n)
SELECT 'chi_square' AS test, cname AS var_a, {q(other)} AS var_b, CAST(n AS BIGINT) AS n, {r('chi2')} AS statistic,
  CAST((rr - 1) * (kk - 1) AS DOUBLE) AS df1, CAST(NULL AS DOUBLE) AS df2,
  {r('CASE WHEN least(rr, kk) - 1 > 0 THEN sqrt((chi2 / n) / (least(rr, kk) - 1)) END')} AS effect_size,
  'Cramer''s V' AS effect_label FROM chi"""


O["t4_chi_square_tests"] = with_loans(_chi(
    ", long AS (SELECT u.cname, u.a, CAST(default_flag AS VARCHAR) AS b FROM loans, LATERAL (VALUES " +
    ", ".join(f"({q(c)}, CAST({c} AS VARCHAR))" for c in CHI) + ") AS u(cname, a) WHERE u.a IS NOT NULL AND default_flag IS NOT NULL)",
    "default_flag"))
O["t4_chi_square_yates_labels"] = "WITH " + _chi(
    "long AS (SELECT 'quality' AS cname, CAST(quality AS VARCHAR) AS a, CAST(toxic AS VARCHAR) AS b FROM labels "
    "WHERE quality IS NOT NULL AND toxic IS NOT NULL)", "toxic")


def _pairs_cte() -> str:
    return ", pr AS (" + " UNION ALL ".join(
        f"SELECT '{a}|{b}' AS pair, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y FROM loans "
        f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a, b in PAIRS) + ")"


def _corr_out(method: str, src: str) -> str:
    label = "Pearson r" if method == "pearson" else "Spearman rho"
    return f"""SELECT {q(method)} AS test, split_part(pair, '|', 1) AS var_a, split_part(pair, '|', 2) AS var_b,
  count(*) AS n, {r('corr(x, y)')} AS statistic, CAST(count(*) - 2 AS DOUBLE) AS df1, CAST(NULL AS DOUBLE) AS df2,
  {r('corr(x, y)')} AS effect_size, {q(label)} AS effect_label FROM {src} GROUP BY pair"""


O["t6_pearson"] = with_loans(_pairs_cte() + "\n" + _corr_out("pearson", "pr"))
O["t6_spearman"] = with_loans(_pairs_cte() + """
, rk AS (SELECT pair, rank() OVER (PARTITION BY pair ORDER BY x) + (count(*) OVER (PARTITION BY pair, x) - 1) / 2.0 AS x,
            rank() OVER (PARTITION BY pair ORDER BY y) + (count(*) OVER (PARTITION BY pair, y) - 1) / 2.0 AS y FROM pr)
""" + _corr_out("spearman", "rk"))

_ALLPAIRS = [(NUM[i], NUM[j]) for i in range(len(NUM)) for j in range(i + 1, len(NUM))]
_MAT = " UNION ALL ".join(f"SELECT {q(a)} AS var_a, {q(b)} AS var_b, corr({b}, {a}) AS r FROM loans" for a, b in _ALLPAIRS)
O["t7_correlation_matrix"] = with_loans(f", m AS ({_MAT})\nSELECT var_a, var_b, {r('r')} AS r FROM m")
O["t8_high_correlation_pairs"] = with_loans(
    f", m AS ({_MAT})\nSELECT var_a, var_b, {r('r')} AS r, {r('abs(r)')} AS abs_r FROM m WHERE abs(r) >= 0.4")
O["t10_target_correlation_rank"] = with_loans(
    ", g AS (SELECT *, CAST(list_position(['A','B','C','D','E','F','G'], grade) - 1 AS BIGINT) AS grade_index FROM loans)"
    ", m AS (" + " UNION ALL ".join(
        f"SELECT {q(c)} AS variable, corr(CAST(default_flag AS DOUBLE), CAST({c} AS DOUBLE)) AS r, "
        f"count(*) FILTER (WHERE {c} IS NOT NULL AND default_flag IS NOT NULL) AS n_pairs FROM g"
        for c in NUM + ["grade_index"]) + ")\n"
    f"SELECT variable, {r('r')} AS r, n_pairs, {r('abs(r)')} AS abs_r FROM m WHERE n_pairs >= 10 AND r IS NOT NULL")

# ------------------------------------------------------------------ evaluation
_YP = ", yp AS (SELECT id, default_flag AS y, p, grade, home_ownership, purpose, term FROM scored)"


def _conf(src: str, t: float = 0.5, keys: str = "") -> str:
    kk = f"{keys}, " if keys else ""
    gb = f" GROUP BY {keys}" if keys else ""
    return (f"SELECT {kk}count(*) FILTER (WHERE p >= {t} AND y = 1) AS tp, count(*) FILTER (WHERE p >= {t} AND y = 0) AS fp, "
            f"count(*) FILTER (WHERE p < {t} AND y = 0) AS tn, count(*) FILTER (WHERE p < {t} AND y = 1) AS fn, "
            f"count(*) AS n FROM {src}{gb}")


O["e1_confusion_counts"] = with_scored(_YP + "\n" + _conf("yp"))

_MET = {
    "accuracy": "(tp + tn) / CAST(n AS DOUBLE)",
    "precision": "coalesce(CASE WHEN tp + fp <> 0 THEN tp / CAST(tp + fp AS DOUBLE) END, 0.0)",
    "recall": "coalesce(CASE WHEN tp + fn <> 0 THEN tp / CAST(tp + fn AS DOUBLE) END, 0.0)",
    "specificity": "CASE WHEN tn + fp <> 0 THEN tn / CAST(tn + fp AS DOUBLE) END",
}
_F1 = "CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END"
_BAL = ("(CASE WHEN tp + fn > 0 THEN rc ELSE 0.0 END + CASE WHEN tn + fp > 0 THEN coalesce(sp, 0.0) ELSE 0.0 END) / "
        "(CASE WHEN tp + fn > 0 THEN 1 ELSE 0 END + CASE WHEN tn + fp > 0 THEN 1 ELSE 0 END)")
_MCC = ("CASE WHEN sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)) > 0 THEN "
        "(CAST(tp AS DOUBLE) * tn - CAST(fp AS DOUBLE) * fn) / sqrt(CAST(tp + fp AS DOUBLE) * (tp + fn) * (tn + fp) * (tn + fn)) "
        "ELSE 0.0 END")


def _metrics_from_conf(conf_cte: str, keys: str = "") -> str:
    kk = f"{keys}, " if keys else ""
    return (f"SELECT {kk}tp, fp, tn, fn, n, {r('acc')} AS accuracy, {r('pr')} AS precision, {r('rc')} AS recall, "
            f"{r('sp')} AS specificity, {r(_F1)} AS f1_score, {r(_BAL)} AS balanced_accuracy, {r(_MCC)} AS matthews_corrcoef "
            f"FROM (SELECT *, {_MET['accuracy']} AS acc, {_MET['precision']} AS pr, {_MET['recall']} AS rc, "
            f"{_MET['specificity']} AS sp FROM {conf_cte})")


def _rank_sql(src: str, keys: str) -> str:
    """AUC / AP per key group from distinct-score counts and prefix sums."""
    return f"""(SELECT {keys}, sum(pos * (neg_before + 0.5 * neg)) AS auc_s,
        sum(pos * ((tot_pos - pos_before) / (tot_c - c_before))) AS ap_s,
        any_value(tot_pos) AS tot_pos, any_value(tot_neg) AS tot_neg FROM (
      SELECT *, coalesce(sum(pos) OVER w, 0) AS pos_before, coalesce(sum(neg) OVER w, 0) AS neg_before,
             coalesce(sum(c) OVER w, 0) AS c_before,
             sum(pos) OVER (PARTITION BY {keys}) AS tot_pos, sum(neg) OVER (PARTITION BY {keys}) AS tot_neg,
             sum(c) OVER (PARTITION BY {keys}) AS tot_c
      FROM (SELECT {keys}, p AS score, count(*) AS c, sum(y) AS pos, sum(1 - y) AS neg FROM {src} GROUP BY {keys}, p)
      WINDOW w AS (PARTITION BY {keys} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    GROUP BY {keys})"""


def _rank_cols() -> str:
    return (f"{r('CASE WHEN tot_pos > 0 AND tot_neg > 0 THEN auc_s / (tot_pos * tot_neg) END')} AS roc_auc, "
            f"{r('CASE WHEN tot_pos > 0 THEN ap_s / tot_pos END')} AS average_precision")


_CLIP = "least(greatest(p, 2.220446049250313e-16), 1 - 2.220446049250313e-16)"
_BIN = "CASE WHEN p >= 0 AND p <= 1 THEN 1 + " + " + ".join(
    f"CASE WHEN p > {i * (1.0 / 10)!r} THEN 1 ELSE 0 END" for i in range(1, 10)) + " END"


def _prob_sql(src: str, keys: str) -> str:
    kk = f"{keys}, " if keys else ""
    gb = f" GROUP BY {keys}" if keys else ""
    return (f"(SELECT {kk}avg(-(y * ln({_CLIP}) + (1 - y) * ln(1 - {_CLIP}))) AS log_loss, "
            f"avg(power(p - y, 2)) AS brier_score, avg(p) AS mean_probability FROM {src}{gb})")


def _ece_sql(src: str, keys: str) -> str:
    kk = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    gb = f" GROUP BY {keys}" if keys else ""
    return (f"(SELECT {kk}sum(n / CAST(nt AS DOUBLE) * abs(mp - obs)) AS calibration_error FROM ("
            f"SELECT {kk}bin, count(*) AS n, avg(p) AS mp, avg(CAST(y AS DOUBLE)) AS obs, "
            f"any_value(nt) AS nt FROM (SELECT *, {_BIN} AS bin, count(*) OVER ({part}) AS nt FROM {src}) "
            f"WHERE bin IS NOT NULL GROUP BY {kk}bin){gb})")


O["e2_classification_metrics"] = with_scored(_YP + f"""
, yk AS (SELECT *, 0 AS k FROM yp)
, base AS ({_metrics_from_conf('(' + _conf('yp') + ')')})
, rk AS {_rank_sql('yk', 'k')}
, pr AS {_prob_sql('yp', '')}
, ec AS {_ece_sql('yp', '')}
SELECT base.*, {r('log_loss')} AS log_loss, {r('brier_score')} AS brier_score, {r('mean_probability')} AS mean_probability,
  {_rank_cols()}, {r('calibration_error')} AS calibration_error FROM base, rk, pr, ec""")

O["e3_rank_metrics_by_grade"] = with_scored(_YP + f"\nSELECT grade, {_rank_cols()} FROM {_rank_sql('yp', 'grade')}")
O["e5_probability_scores"] = with_scored(
    _YP + f"\nSELECT {r('log_loss')} AS log_loss, {r('brier_score')} AS brier_score, "
    f"{r('mean_probability')} AS mean_probability FROM {_prob_sql('yp', '')}")
O["e7_expected_calibration_error"] = with_scored(_YP + f"\nSELECT {r('calibration_error')} AS calibration_error FROM {_ece_sql('yp', '')}")
O["e8_reliability_curve"] = with_scored(_YP + f"""
SELECT bin, count(*) AS n, {r('avg(p)')} AS mean_predicted, {r('avg(CAST(y AS DOUBLE))')} AS observed_rate
FROM (SELECT *, {_BIN} AS bin FROM yp) WHERE bin IS NOT NULL GROUP BY bin""")

O["e9_roc_pr_points"] = with_scored(_YP + f"""
, d AS (SELECT p AS threshold, count(*) AS c, sum(y) AS pos, sum(1 - y) AS neg FROM yp GROUP BY p)
, cum AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS pos_before, coalesce(sum(neg) OVER w, 0) AS neg_before,
            sum(pos) OVER () AS tot_pos, sum(neg) OVER () AS tot_neg FROM d
          WINDOW w AS (ORDER BY threshold ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT {r('threshold')} AS threshold, {r('CASE WHEN tot_neg <> 0 THEN (tot_neg - neg_before) / tot_neg END')} AS fpr,
  {r('CASE WHEN tot_pos <> 0 THEN (tot_pos - pos_before) / tot_pos END')} AS tpr,
  {r('CASE WHEN (tot_pos - pos_before) + (tot_neg - neg_before) <> 0 THEN (tot_pos - pos_before) / ((tot_pos - pos_before) + (tot_neg - neg_before)) END')} AS precision,
  {r('CASE WHEN tot_pos <> 0 THEN (tot_pos - pos_before) / tot_pos END')} AS recall, {r('tot_pos / (tot_pos + tot_neg)')} AS prevalence FROM cum""")

_GRID = ", ".join(f"(CAST({t!r} AS DOUBLE))" for t in R.THRESHOLD_GRID)


def _threshold_sql(src: str, keys: str = "") -> str:
    kk = f"{keys}, " if keys else ""
    return f"""(SELECT {kk}threshold, CAST(count(*) FILTER (WHERE p >= threshold AND y = 1) AS BIGINT) AS tp,
      CAST(count(*) FILTER (WHERE p >= threshold AND y = 0) AS BIGINT) AS fp,
      CAST(count(*) FILTER (WHERE p < threshold AND y = 0) AS BIGINT) AS tn,
      CAST(count(*) FILTER (WHERE p < threshold AND y = 1) AS BIGINT) AS fn
    FROM {src}, (VALUES {_GRID}) AS g(threshold) GROUP BY {kk}threshold)"""


def _threshold_cols() -> str:
    pr = "CASE WHEN tp + fp <> 0 THEN tp / CAST(tp + fp AS DOUBLE) END"
    rc = "CASE WHEN tp + fn <> 0 THEN tp / CAST(tp + fn AS DOUBLE) END"
    f1 = f"CASE WHEN ({pr}) > 0 AND ({rc}) > 0 THEN 2 * ({pr}) * ({rc}) / (({pr}) + ({rc})) ELSE 0.0 END"
    n = "CAST(tp + fp + tn + fn AS DOUBLE)"
    return (f"{r('threshold')} AS threshold, {r(pr)} AS precision, {r(rc)} AS recall, {r('CASE WHEN tn + fp <> 0 THEN tn / CAST(tn + fp AS DOUBLE) END')} AS specificity, "
            f"{r(f1)} AS f1_score, {r(f'(tp + tn) / {n}')} AS accuracy, {r(f'(fn * 5.0 + fp * 1.0) / {n}')} AS expected_cost_per_loan, "
            f"tp + fp AS n_flagged_as_risky, {r(f'(tn + fn) / {n}')} AS approval_rate, "
            f"{r('CASE WHEN fp + tn <> 0 THEN fp / CAST(fp + tn AS DOUBLE) END')} AS false_positive_rate, "
            f"{r('CASE WHEN fn + tp <> 0 THEN fn / CAST(fn + tp AS DOUBLE) END')} AS false_negative_rate")


O["e11_threshold_table"] = with_scored(_YP + f"\nSELECT {_threshold_cols()} FROM {_threshold_sql('yp')}")
O["e13_recommend_threshold"] = with_scored(_YP + f"""
, t AS (SELECT term, {_threshold_cols()}, (fn * 5.0 + fp * 1.0) / CAST(tp + fp + tn + fn AS DOUBLE) AS cost_raw
        FROM {_threshold_sql('yp', 'term')})
SELECT * EXCLUDE (rn, cost_raw) FROM (SELECT *, row_number() OVER (PARTITION BY term ORDER BY cost_raw, threshold) AS rn FROM t)
WHERE rn = 1""")

_TWO = (", two AS (SELECT 'score_a' AS model, default_flag AS y, p FROM scored UNION ALL "
        "SELECT 'score_b', default_flag, CAST((id * 16807) % 1000 AS DOUBLE) / 1000.0 * 0.5 + default_flag * 0.3 FROM scored)")
O["e14_calibration_report"] = with_scored(_TWO + f"""
SELECT a.model, {r('mean_probability')} AS mean_probability, {r('brier_score')} AS brier_score,
  {r('calibration_error')} AS calibration_error FROM {_prob_sql('two', 'model')} a JOIN {_ece_sql('two', 'model')} b USING (model)""")

# ------------------------------------------------------------------ fairness
_FAIR_LONG = (", fl AS (SELECT y, p, u.group_column, u.group_value FROM yp, LATERAL (VALUES "
              "('home_ownership', CAST(home_ownership AS VARCHAR)), ('purpose', CAST(purpose AS VARCHAR)), "
              "('grade', CAST(grade AS VARCHAR))) AS u(group_column, group_value) WHERE u.group_value IS NOT NULL)"
              ", sizes AS (SELECT group_column, group_value, count(*) AS n, avg(CAST(y AS DOUBLE)) AS adr, avg(p) AS mpp "
              "FROM fl GROUP BY group_column, group_value)"
              ", el AS (SELECT fl.* FROM fl JOIN sizes USING (group_column, group_value) WHERE n >= 10)")
_FK = "group_column, group_value"
_FAIR = with_scored(_YP + _FAIR_LONG + f"""
, base AS ({_metrics_from_conf('(' + _conf('el', 0.5, _FK) + ')', _FK)})
, rk AS {_rank_sql('el', _FK)}
, pr AS {_prob_sql('el', _FK)}
, ec AS {_ece_sql('el', _FK)}
, rep AS (SELECT s.group_column, s.group_value, s.n, {r('adr')} AS actual_default_rate, {r('mpp')} AS mean_predicted_probability,
  base.accuracy, base.precision, base.recall, base.specificity, base.f1_score, base.balanced_accuracy, base.matthews_corrcoef,
  {_rank_cols()}, {r('log_loss')} AS log_loss, {r('brier_score')} AS brier_score, {r('calibration_error')} AS calibration_error
  FROM sizes s JOIN base USING ({_FK}) JOIN rk USING ({_FK}) JOIN pr USING ({_FK}) JOIN ec USING ({_FK}) WHERE s.n >= 10)
""")
O["n1_fairness_report"] = _FAIR + "SELECT * FROM rep"
O["n2_fairness_disparities"] = _FAIR + f""", rraw AS (SELECT group_column,
    coalesce(CASE WHEN tp + fn <> 0 THEN tp / CAST(tp + fn AS DOUBLE) END, 0.0) AS rc FROM ({_conf('el', 0.5, _FK)}))
SELECT group_column, {r('min(rc)')} AS min_value, {r('max(rc)')} AS max_value,
  {r('max(rc) - min(rc)')} AS spread, 'recall' AS metric FROM rraw GROUP BY group_column"""

# ------------------------------------------------------------------ policy
O["p2_predict_labels"] = with_scored("SELECT id, CAST(p >= 0.35 AS INTEGER) AS predicted_default FROM scored")


def _map_sql(x: str, pairs) -> str:
    return "CASE " + x + " " + " ".join(f"WHEN {q(k)} THEN {q(v) if isinstance(v, str) else repr(float(v))}"
                                        for k, v in pairs) + " END"


_TIERS = [t[0] for t in R.RISK_TIERS]
def _tenth(x):
    """SQL: one decimal by the exact value of the double, a true half to the even
    digit (see ``policy.round_tenth`` for the arithmetic)."""
    k = f"floor({x} * 10)"
    h = f"((2 * {k} + 1) / 20.0)"
    over = f"(({h} * 16.0 + {h} * 4.0) - (2 * {k} + 1))"
    low = f"(({h} * 16.0 - (({h} * 16.0 + {h} * 4.0) - (({h} * 16.0 + {h} * 4.0) - {h} * 16.0))) + ({h} * 4.0 - (({h} * 16.0 + {h} * 4.0) - {h} * 16.0)))"
    up = f"CASE WHEN {x} <> {h} THEN {x} > {h} WHEN {over} + {low} <> 0 THEN {over} + {low} > 0 ELSE {k} % 2 = 1 END"
    return f"(({k} + CASE WHEN {up} THEN 1 ELSE 0 END) / 10.0)"


_SCORE = with_scored(f"""
, s AS (SELECT id, p AS default_probability, {TIER} AS risk_tier, {GRADE} AS model_loan_grade FROM scored)
, sc AS (SELECT id, {r('default_probability')} AS default_probability, CAST(default_probability >= 0.5 AS INTEGER) AS predicted_default,
  {r(_tenth('(default_probability * 100)'))} AS risk_score,
  {r(_tenth('(abs(default_probability - 0.5) * 200)'))} AS confidence, risk_tier,
  {_map_sql('risk_tier', [(t[0], t[3]) for t in R.RISK_TIERS])} AS tier_description,
  {_map_sql('risk_tier', [(a[0], a[1]) for a in R.LENDING_ACTIONS])} AS lending_action,
  {_map_sql('risk_tier', [(a[0], a[2]) for a in R.LENDING_ACTIONS])} AS action_rationale,
  {r('round_even(' + str(R.BASE_INTEREST_RATE) + ' + (' + _map_sql('risk_tier', list(R.RATE_ADJUSTMENT_BPS.items())) + ') / 100.0, 2)')} AS recommended_rate,
  model_loan_grade FROM s)
""")
O["p8_batch_scoring"] = _SCORE + "SELECT * FROM sc"
O["p10_tier_distribution"] = _SCORE + ", dim AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {q(t)})" for i, t in enumerate(_TIERS)) + f""") AS d(tier_order, risk_tier))
, cnt AS (SELECT risk_tier, count(*) AS n FROM sc GROUP BY risk_tier)
SELECT dim.tier_order, dim.risk_tier, CAST(coalesce(n, 0) AS BIGINT) AS n_loans,
  {r('CASE WHEN sum(coalesce(n, 0)) OVER () > 0 THEN coalesce(n, 0) / sum(coalesce(n, 0)) OVER () END')} AS share
FROM dim LEFT JOIN cnt USING (risk_tier)"""
