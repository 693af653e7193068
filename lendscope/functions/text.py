"""String column functions: labels, title case, feature-name humanising.

Everything is a Spark column expression (split/transform/array_join, map
lookups), so labelling a billion-row importance table stays inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendscope import roles as R

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as listed)
# ---------------------------------------------------------------------------

GLOSSARY = {
    "loan_amnt": "Dollar amount of the loan requested by the borrower.",
    "term": "Number of monthly payments (36 or 60 months).",
    "int_rate": "Annual interest rate assigned to the loan (%).",
    "installment": "Fixed monthly payment owed by the borrower ($).",
    "grade": "LendingClub-assigned risk grade (A = lowest risk, G = highest).",
    "home_ownership": "Borrower's home ownership status (RENT/MORTGAGE/OWN/OTHER).",
    "annual_inc": "Self-reported annual income ($).",
    "verification_status": "Whether income was verified by LendingClub.",
    "purpose": "Borrower-stated reason for the loan.",
    "dti": "Debt-to-income ratio, excluding mortgage, based on reported income.",
    "delinq_2yrs": "Number of 30+ day delinquencies in the past 2 years.",
    "open_acc": "Number of open credit lines in the borrower's credit file.",
    "pub_rec": "Number of derogatory public records.",
    "revol_bal": "Total revolving credit balance ($).",
    "revol_util": "Revolving line utilization rate (%) — balance vs. total credit.",
    "total_acc": "Total number of credit lines currently in the credit file.",
    "initial_list_status": "Initial listing status of the loan (whole/fractional).",
    "application_type": "Individual vs. joint loan application.",
    "mort_acc": "Number of mortgage accounts.",
    "pub_rec_bankruptcies": "Number of public record bankruptcies.",
    "emp_length_years": "Borrower's employment length in years (parsed; 10 = 10+).",
    "default_flag": "Binary target: 1 = Charged Off/Default, 0 = Fully Paid.",
}
GLOSSARY_DEFAULT = "See project data dictionary."

COLUMN_LABELS = {
    "loan_amnt": "Loan Amount",
    "int_rate": "Interest Rate",
    "installment": "Monthly Installment",
    "annual_inc": "Annual Income",
    "dti": "Debt-to-Income Ratio",
    "delinq_2yrs": "Delinquencies (Past 2 Years)",
    "open_acc": "Open Credit Accounts",
    "pub_rec": "Public Records",
    "revol_bal": "Revolving Balance",
    "revol_util": "Credit Utilization",
    "total_acc": "Total Accounts",
    "mort_acc": "Mortgage Accounts",
    "pub_rec_bankruptcies": "Bankruptcies",
    "emp_length_years": "Employment Length",
    "term": "Loan Term",
    "home_ownership": "Home Ownership",
    "verification_status": "Verification Status",
    "purpose": "Loan Purpose",
    "initial_list_status": "Listing Status",
    "application_type": "Application Type",
    "grade": "Credit Grade",
    "rank": "Rank",
    "model": "Model",
    "accuracy": "Accuracy",
    "precision": "Precision",
    "recall": "Recall",
    "specificity": "Specificity",
    "f1_score": "F1 Score",
    "roc_auc": "ROC-AUC",
    "balanced_accuracy": "Balanced Accuracy",
    "cv_roc_auc_mean": "CV ROC-AUC (Mean)",
    "cv_roc_auc_std": "CV ROC-AUC (Std)",
    "training_time_sec": "Training Time (sec)",
    "prediction_time_ms_per_1000": "Prediction Time (ms/1000)",
    "memory_usage_kb": "Memory (KB)",
    "interpretability": "Interpretability",
    "complexity": "Complexity",
    "deployment_readiness": "Deployment Readiness",
    "feature_label": "Feature",
    "mean_abs_shap": "Mean |SHAP|",
    "permutation_importance": "Permutation Importance",
    "research_question": "Research Question",
    "segment_name": "Segment",
    "cluster_id": "Cluster ID",
    "n_borrowers": "Borrowers",
    "pct_of_portfolio": "% of Portfolio",
    "typical_income": "Typical Income",
    "typical_interest_rate": "Typical Interest Rate",
    "typical_loan_grade": "Typical Grade",
    "typical_dti": "Typical DTI",
    "typical_employment_length": "Typical Employment (Yrs)",
    "average_default_rate": "Default Rate",
    "risk_tier": "Risk Tier",
    "mean_predicted_probability": "Predicted Probability",
    "default_flag": "Default",
}

CATEGORY_LABELS = {
    "purpose": {
        "car": "Car",
        "credit_card": "Credit Card",
        "debt_consolidation": "Debt Consolidation",
        "home_improvement": "Home Improvement",
        "house": "House",
        "major_purchase": "Major Purchase",
        "medical": "Medical",
        "moving": "Moving",
        "other": "Other",
        "renewable_energy": "Renewable Energy",
        "small_business": "Small Business",
        "vacation": "Vacation",
        "wedding": "Wedding",
    },
    "home_ownership": {
        "ANY": "Any",
        "MORTGAGE": "Mortgage",
        "OWN": "Own",
        "RENT": "Rent",
        "OTHER": "Other",
        "NONE": "None",
    },
    "verification_status": {
        "Not Verified": "Not Verified",
        "Source Verified": "Source Verified",
        "Verified": "Verified",
    },
    "term": {
        "36 months": "36 Months",
        "60 months": "60 Months",
    },
    "application_type": {
        "Individual": "Individual",
        "Joint App": "Joint Application",
    },
    "initial_list_status": {
        "f": "Fractional",
        "w": "Whole",
    },
}

LITTLE_WORDS = ["a", "an", "the", "and", "but", "or", "for", "nor", "of", "on",
                "to", "in", "at", "by", "with"]

FEATURE_LABELS = {
    "loan_amnt": "Loan amount",
    "int_rate": "Interest rate",
    "installment": "Monthly installment",
    "annual_inc": "Annual income",
    "dti": "Debt-to-income ratio",
    "delinq_2yrs": "Delinquencies (past 2 years)",
    "open_acc": "Open credit accounts",
    "pub_rec": "Public derogatory records",
    "revol_bal": "Revolving credit balance",
    "revol_util": "Revolving credit utilization",
    "total_acc": "Total credit accounts",
    "mort_acc": "Mortgage accounts",
    "pub_rec_bankruptcies": "Bankruptcies on record",
    "emp_length_years": "Employment length (years)",
    "term": "Loan term",
    "home_ownership": "Home ownership status",
    "verification_status": "Income verification status",
    "purpose": "Loan purpose",
    "initial_list_status": "Initial listing status",
    "application_type": "Application type",
    "grade": "LendingClub credit grade",
}

TRANSFORMER_PREFIXES = ["onehot_categorical__", "ordinal_categorical__", "numeric__"]

# The research question of each field; of two fields that fit a name the one listed first counts.
RESEARCH_QUESTIONS = {
    "grade": "RQ2 (are LendingClub grades predictive of default?)",
    "int_rate": "RQ3 (which variables relate to higher interest rates?)",
    "annual_inc": "RQ4 (does income relate to repayment success?)",
    "dti": "RQ5 (does DTI influence default?)",
    "emp_length_years": "RQ6 (does employment length matter?)",
    "loan_amnt": "RQ1 (which borrower characteristics associate with default?)",
    "installment": "RQ1 (which borrower characteristics associate with default?)",
    "home_ownership": "RQ1 (which borrower characteristics associate with default?)",
    "purpose": "RQ1 (which borrower characteristics associate with default?)",
    "revol_util": "RQ1 (which borrower characteristics associate with default?)",
    "delinq_2yrs": "RQ1 (which borrower characteristics associate with default?)",
    "pub_rec": "RQ1 (which borrower characteristics associate with default?)",
    "pub_rec_bankruptcies": "RQ1 (which borrower characteristics associate with default?)",
    "mort_acc": "RQ1 (which borrower characteristics associate with default?)",
    "revol_bal": "RQ1 (which borrower characteristics associate with default?)",
    "total_acc": "RQ1 (which borrower characteristics associate with default?)",
    "open_acc": "RQ1 (which borrower characteristics associate with default?)",
    "verification_status": "RQ1 (which borrower characteristics associate with default?)",
    "term": "RQ1 (which borrower characteristics associate with default?)",
    "application_type": "RQ1 (which borrower characteristics associate with default?)",
    "initial_list_status": "RQ1 (which borrower characteristics associate with default?)",
}

# ---------------------------------------------------------------------------


def _map(d: dict) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def smart_title_case(c: Column) -> Column:
    """snake_case / mixed case -> Title Case; connector words lower except first."""
    words = F.filter(F.split(F.trim(F.replace(c.cast("string"), F.lit("_"), F.lit(" "))), r"\s+"),
                     lambda w: w != "")
    little = F.array(*[F.lit(w) for w in LITTLE_WORDS])
    titled = F.transform(words, lambda w, i: F.when(
        (i > 0) & F.array_contains(little, F.lower(w)), F.lower(w))
        .otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 1 << 30)))))
    return F.array_join(titled, " ")


def column_label(c: Column) -> Column:
    return F.coalesce(_map(COLUMN_LABELS)[c], smart_title_case(c))


def category_label(column: str, value: Column) -> Column:
    key = F.trim(value.cast("string"))
    m = CATEGORY_LABELS.get(column)
    if m:
        return F.coalesce(_map(m)[key], smart_title_case(key))
    return smart_title_case(key)


def _python_title(c: Column) -> Column:
    """str.title() for words made of letters/digits separated by spaces."""
    return F.initcap(F.lower(c))


def strip_transformer_prefix(c: Column) -> Column:
    pat = "^(" + "|".join(TRANSFORMER_PREFIXES) + ")"
    return F.regexp_replace(c, pat, "")


def humanize_feature_name(c: Column) -> Column:
    """``onehot_categorical__purpose_car`` -> ``Loan purpose: Car``;
    ``numeric__dti`` -> ``Debt-to-income ratio``; else cleaned text."""
    rem = strip_transformer_prefix(c)
    onehot = c.startswith("onehot_categorical__")
    bases = sorted(R.ONEHOT_FEATURES, key=len, reverse=True)  # longest base first
    expr = None
    for b in bases:
        cond = onehot & rem.startswith(b + "_")
        cat = F.trim(F.replace(F.substring(rem, len(b) + 2, 1 << 30), F.lit("_"), F.lit(" ")))
        lab = F.concat(F.lit(FEATURE_LABELS.get(b, b.replace("_", " ").title()) + ": "), _python_title(cat))
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    fallback = F.coalesce(_map(FEATURE_LABELS)[rem], _capitalize(F.trim(F.replace(rem, F.lit("_"), F.lit(" ")))))
    return expr.otherwise(fallback)


def _capitalize(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def research_question(c: Column) -> Column:
    """First research question whose raw name equals or prefixes (``name_``) the feature."""
    rem = strip_transformer_prefix(c)
    expr = None
    for raw, q in RESEARCH_QUESTIONS.items():
        cond = (rem == raw) | rem.startswith(raw + "_")
        expr = F.when(cond, q) if expr is None else expr.when(cond, q)
    return expr.otherwise(F.lit(None).cast("string"))
