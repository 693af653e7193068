"""Column roles and the fixed values every operator relies on.

``ColumnRoles`` tells operators which columns are numeric, nominal, ordinal and
which is the binary outcome, so the same operators run on any table with a
binary outcome.  The constants below are fixed values of the analysed
domain (category maps, feature groups, policy defaults); results depend on
them being exactly these.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values (must stay exactly as listed)
# ---------------------------------------------------------------------------

RANDOM_STATE = 42
TARGET_STATE = "IN"
STATE_COLUMN = "addr_state"
STATUS_COLUMN = "loan_status"
TARGET_COLUMN = "default_flag"

# loan_status -> outcome; statuses not listed are dropped (unresolved loans)
LOAN_STATUS_TARGET_MAP = {
    "Fully Paid": 0,
    "Charged Off": 1,
    "Default": 1,
}

PERCENTAGE_COLUMNS = ["int_rate", "revol_util"]

EMP_LENGTH_RAW_COLUMN = "emp_length"
EMP_LENGTH_NUMERIC_COLUMN = "emp_length_years"
EMP_LENGTH_MAP = {
    "< 1 year": 0.0,
    "1 year": 1.0,
    "2 years": 2.0,
    "3 years": 3.0,
    "4 years": 4.0,
    "5 years": 5.0,
    "6 years": 6.0,
    "7 years": 7.0,
    "8 years": 8.0,
    "9 years": 9.0,
    "10+ years": 10.0,
}

NUMERIC_FEATURES = [
    "loan_amnt", "int_rate", "installment", "annual_inc", "dti", "delinq_2yrs",
    "open_acc", "pub_rec", "revol_bal", "revol_util", "total_acc", "mort_acc",
    "pub_rec_bankruptcies", "emp_length_years",
]
ONEHOT_FEATURES = [
    "term", "home_ownership", "verification_status", "purpose",
    "initial_list_status", "application_type",
]
ORDINAL_FEATURES = ["grade"]
GRADE_ORDER = ["A", "B", "C", "D", "E", "F", "G"]

EXCLUDED_COLUMNS = [
    "id", "member_id", "emp_title", "url", "desc", "title", "zip_code",
    "addr_state", "issue_d", "earliest_cr_line", "sub_grade", "loan_status",
    "emp_length",
]

EXPECTED_RAW_COLUMNS = sorted(
    set(NUMERIC_FEATURES + ONEHOT_FEATURES + ORDINAL_FEATURES + EXCLUDED_COLUMNS
        + [STATUS_COLUMN, STATE_COLUMN, EMP_LENGTH_RAW_COLUMN])
    - {EMP_LENGTH_NUMERIC_COLUMN}
)

TEST_SIZE = 0.15
VALIDATION_SIZE = 0.15
CV_FOLDS = 5

THRESHOLD_GRID = [round(i / 100, 2) for i in range(5, 96, 5)]
COST_FALSE_NEGATIVE = 5.0
COST_FALSE_POSITIVE = 1.0
CALIBRATION_BINS = 10
SIGNIFICANCE_LEVEL = 0.05
WINSOR_IQR_MULTIPLIER = 3.0
BASE_INTEREST_RATE = 10.0

# columns profiled per segment
PROFILE_NUMERIC_COLUMNS = [
    "annual_inc", "dti", "loan_amnt", "int_rate", "emp_length_years",
    "revol_util", "revol_bal", "open_acc", "total_acc", "mort_acc",
]
PROFILE_CATEGORICAL_COLUMNS = ["grade", "home_ownership", "purpose"]

K_CANDIDATES = [2, 3, 4, 5, 6]

# Risk policy defaults: (name, min p, max p, description)
RISK_TIERS = [
    ("Low Risk", 0.00, 0.15,
     "Strong repayment profile; default probability is low relative to the portfolio."),
    ("Moderate Risk", 0.15, 0.35,
     "Acceptable repayment profile with some risk factors present."),
    ("High Risk", 0.35, 0.60,
     "Elevated default probability; multiple risk factors present."),
    ("Very High Risk", 0.60, 1.01,
     "Default probability is high; approval is not recommended without mitigation."),
]
# (tier, action, rationale)
LENDING_ACTIONS = [
    ("Low Risk", "Approve", "Proceed with standard underwriting terms."),
    ("Moderate Risk", "Approve with Conditions",
     "Approve with a rate adjustment and/or reduced principal to price in the added risk."),
    ("High Risk", "Manual Review",
     "Route to a credit analyst for manual review before a decision is made."),
    ("Very High Risk", "Decline",
     "Decline under standard policy; only proceed via an exception process."),
]
RATE_ADJUSTMENT_BPS = {
    "Low Risk": -50.0,
    "Moderate Risk": 0.0,
    "High Risk": 150.0,
    "Very High Risk": 400.0,
}
# (grade, min p, max p)
LOAN_GRADE_BANDS = [
    ("A", 0.00, 0.08),
    ("B", 0.08, 0.15),
    ("C", 0.15, 0.25),
    ("D", 0.25, 0.40),
    ("E", 0.40, 0.55),
    ("F", 0.55, 0.70),
    ("G", 0.70, 1.01),
]

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class ColumnRoles:
    """Which columns play which role; operators never hard-code names."""

    numeric: tuple = tuple(NUMERIC_FEATURES)
    nominal: tuple = tuple(ONEHOT_FEATURES)
    ordinal: tuple = tuple(ORDINAL_FEATURES)
    ordinal_orders: dict = field(default_factory=lambda: {"grade": list(GRADE_ORDER)})
    target: str = TARGET_COLUMN
    row_id: str = "id"

    @property
    def features(self) -> list:
        return list(self.numeric) + list(self.nominal) + list(self.ordinal)


LOAN_ROLES = ColumnRoles()
