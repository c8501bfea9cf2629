"""Column names, types and code lists of the account tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and codes that results must carry unchanged.
ID = "ID"
TARGET = "default_next_month"
TARGET_SPELLINGS = ["default payment next month", "default.payment.next.month", "default"]

MONTHS = [1, 2, 3, 4, 5, 6]  # 1 = newest, 6 = oldest
STATUS = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
BILLS = [f"BILL_AMT{i}" for i in MONTHS]
PAYMENTS = [f"PAY_AMT{i}" for i in MONTHS]
CATEGORICAL = ["SEX", "EDUCATION", "MARRIAGE"]

UTILIZATION = [f"UTIL_{i}" for i in MONTHS]
COVERAGE = [f"PAYCOV_{i}" for i in MONTHS[:5]]

UTILIZATION_FEATURES = UTILIZATION + [
    "UTIL_AVG", "UTIL_MAX", "UTIL_MIN", "UTIL_LATEST", "UTIL_VOLATILITY", "UTIL_TREND",
]
COVERAGE_FEATURES = COVERAGE + ["PAYCOV_AVG", "PAYCOV_LATEST", "PAYCOV_TREND"]
DELINQUENCY_FEATURES = [
    "N_MONTHS_DELINQUENT", "MAX_DELINQUENCY", "AVG_DELINQUENCY_SEVERITY",
    "RECENT_DELINQUENCY", "SEVERE_DELINQUENCY_FLAG", "PERSISTENT_DELINQUENCY_FLAG",
]
BALANCE_FEATURES = [
    f"{series}_{stat}"
    for series in ("BILL", "PAYAMT")
    for stat in ("AVG", "LATEST", "MAX", "TREND", "VOLATILITY")
]
EXPOSURE_FEATURES = ["BALANCE_TO_LIMIT_LATEST", "PAYMENT_CAPACITY", "UTILIZATION_STRESS_FLAG"]
ALL_FEATURES = (
    UTILIZATION_FEATURES + COVERAGE_FEATURES + DELINQUENCY_FEATURES
    + BALANCE_FEATURES + EXPOSURE_FEATURES
)

FLAGS = [
    "RECENT_DELINQUENCY", "SEVERE_DELINQUENCY_FLAG",
    "PERSISTENT_DELINQUENCY_FLAG", "UTILIZATION_STRESS_FLAG",
]

# Model inputs: raw numerics, then every engineered column except the monthly ratios.
NUMERIC = (
    ["LIMIT_BAL", "AGE"] + STATUS + BILLS + PAYMENTS
    + [f for f in ALL_FEATURES if f not in UTILIZATION + COVERAGE]
)

RISK_BANDS = ["Low Risk", "Moderate Risk", "High Risk", "Very High Risk"]
TOP_BANDS = RISK_BANDS[2:]
EDUCATION_LABELS = {1: "Graduate", 2: "University", 3: "High School", 4: "Other/Unknown"}
LGD_SCENARIOS = [0.45, 0.60, 0.75]

_CODES = T.IntegerType()
_MONEY = T.DoubleType()


def account_schema(target: str | None = TARGET) -> T.StructType:
    """Raw account record; `target=None` gives the record a scoring request carries."""
    fields = [T.StructField(ID, T.LongType()), T.StructField("LIMIT_BAL", _MONEY)]
    fields += [T.StructField(c, _CODES) for c in CATEGORICAL + ["AGE"] + STATUS]
    fields += [T.StructField(c, _MONEY) for c in BILLS + PAYMENTS]
    if target is not None:
        fields.append(T.StructField(target, _CODES))
    return T.StructType(fields)
