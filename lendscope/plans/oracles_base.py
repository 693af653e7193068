"""SQL building blocks for the independent oracle statements.

These are plain ANSI/DuckDB SQL over the driver's tables; they re-state the
stand-in input and the cleaning rules so every oracle is self-contained.
"""

LOAN_RAW_SQL = """
lines AS (
  SELECT l_orderkey, count(*) AS n_lines, max(l_discount) AS max_disc, max(l_tax) AS max_tax,
         max(l_quantity) AS max_qty, max(l_extendedprice) AS max_ext,
         count(*) FILTER (WHERE l_linestatus = 'F') AS n_f,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_r,
         count(DISTINCT l_partkey) AS n_parts
  FROM lineitem GROUP BY l_orderkey),
loan_raw AS (
  SELECT o_orderkey AS id, o_custkey AS member_id, o_totalprice / 10 AS loan_amnt,
    CASE WHEN n_lines > 4 THEN ' 60 months' ELSE ' 36 months' END AS term,
    CAST(CAST(round(max_disc * 100) AS INTEGER) AS VARCHAR) || '%' AS int_rate,
    o_totalprice / 360 AS installment,
    ['A','B','C','D','E'][CAST(substr(o_orderpriority, 1, 1) AS INTEGER)] AS grade,
    CASE o_custkey % 12 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years'
         WHEN 11 THEN NULL ELSE CAST(o_custkey % 12 AS VARCHAR) || ' years' END AS emp_length,
    r_name AS home_ownership,
    CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal * 10 END AS annual_inc,
    CASE WHEN n_f = n_lines THEN 'Verified' WHEN n_f = 0 THEN 'Not Verified'
         ELSE 'Source Verified' END AS verification_status,
    CASE WHEN o_orderstatus = 'F' THEN 'Fully Paid'
         WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 'Charged Off'
         WHEN o_orderstatus = 'P' THEN 'Fully Paid'
         WHEN o_orderstatus = 'O' THEN 'Current' END AS loan_status,
    c_mktsegment AS purpose, n_name AS addr_state, max_qty AS dti, n_r AS delinq_2yrs,
    n_lines AS open_acc, n_nationkey % 3 AS pub_rec, max_ext AS revol_bal,
    CAST(CAST(round(max_tax * 1000) AS INTEGER) AS VARCHAR) || '%' AS revol_util,
    n_parts AS total_acc, o_orderkey % 8 AS mort_acc, o_custkey % 2 AS pub_rec_bankruptcies,
    CASE WHEN o_orderkey % 2 = 0 THEN 'f' ELSE 'w' END AS initial_list_status,
    CASE WHEN o_orderkey % 13 = 0 THEN 'Joint App' ELSE 'Individual' END AS application_type
  FROM orders JOIN lines ON o_orderkey = l_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def _pct(c: str) -> str:
    return (f"CASE WHEN isnan(TRY_CAST(replace(replace(trim(CAST({c} AS VARCHAR)), '%', ''), 'nan', '') AS DOUBLE)) "
            f"THEN NULL ELSE TRY_CAST(replace(replace(trim(CAST({c} AS VARCHAR)), '%', ''), 'nan', '') AS DOUBLE) END")


# cleaned loans, ``id`` kept (C2-C5; C6 drops only what no query reads)
LOANS_SQL = LOAN_RAW_SQL + """,
loan_dedup AS (SELECT DISTINCT * FROM loan_raw),
loans AS (
  SELECT id, addr_state,
    CAST(loan_amnt AS DOUBLE) AS loan_amnt, term, """ + _pct("int_rate") + """ AS int_rate,
    CAST(installment AS DOUBLE) AS installment, grade,
    CAST(CASE trim(emp_length) WHEN '< 1 year' THEN 0.0 WHEN '1 year' THEN 1.0 WHEN '2 years' THEN 2.0
      WHEN '3 years' THEN 3.0 WHEN '4 years' THEN 4.0 WHEN '5 years' THEN 5.0 WHEN '6 years' THEN 6.0
      WHEN '7 years' THEN 7.0 WHEN '8 years' THEN 8.0 WHEN '9 years' THEN 9.0 WHEN '10+ years' THEN 10.0
      END AS DOUBLE) AS emp_length_years,
    home_ownership, CAST(annual_inc AS DOUBLE) AS annual_inc, verification_status, purpose,
    CAST(dti AS DOUBLE) AS dti, CAST(delinq_2yrs AS DOUBLE) AS delinq_2yrs,
    CAST(open_acc AS DOUBLE) AS open_acc, CAST(pub_rec AS DOUBLE) AS pub_rec,
    CAST(revol_bal AS DOUBLE) AS revol_bal, """ + _pct("revol_util") + """ AS revol_util,
    CAST(total_acc AS DOUBLE) AS total_acc, CAST(mort_acc AS DOUBLE) AS mort_acc,
    CAST(pub_rec_bankruptcies AS DOUBLE) AS pub_rec_bankruptcies,
    initial_list_status, application_type,
    CAST(CASE loan_status WHEN 'Fully Paid' THEN 0 WHEN 'Charged Off' THEN 1 WHEN 'Default' THEN 1 END
         AS INTEGER) AS default_flag
  FROM loan_dedup
  WHERE loan_status IN ('Fully Paid', 'Charged Off', 'Default'))"""

# deterministic stand-in score
SCORED_SQL = LOANS_SQL + """,
scored AS (SELECT *, CAST((id * 48271) % 1000 AS DOUBLE) / 1000.0 * 0.6 + default_flag * 0.2 AS p FROM loans)"""


def with_loans(body: str) -> str:
    return "WITH " + LOANS_SQL + "\n" + body


def with_scored(body: str) -> str:
    return "WITH " + SCORED_SQL + "\n" + body


def with_raw(body: str) -> str:
    return "WITH " + LOAN_RAW_SQL + "\n" + body
