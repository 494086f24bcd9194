"""Names, sets, thresholds and formats that results must match exactly."""

# Texts that stand for a missing value (compared in lower case after trimming).
NULL_MARKERS = ["", "null", "none", "n/a", "na", "nil", "-"]
NULL_MARKERS_SHORT = ["", "null", "none", "n/a"]

# Date formats tried in this order (Spark pattern letters), each with the shape of text it can read.
DATE_FORMATS = [
    ("yyyy-M-d", r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
    ("M/d/yyyy", r"^(0?[1-9]|1[0-2])/[0-9]{1,2}/[0-9]{4}$"),
    ("d-MMM-yyyy", r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}$"),
    ("d/M/yyyy", r"^[0-9]{1,2}/(0?[1-9]|1[0-2])/[0-9]{4}$"),
    ("yyyyMMdd", r"^[0-9]{8}$"),
]

# Loan rules.
LOAN_TYPES = ["PERSONAL", "AUTO", "MORTGAGE", "CREDIT_CARD", "STUDENT", "HOME_EQUITY"]
LOAN_REQUIRED = ["loan_id", "customer_id", "amount", "application_date"]
MAX_LOAN_AMOUNT = 10_000_000
CREDIT_SCORE_RANGE = (300, 850)
INTEREST_RATE_RANGE = (0, 30)

# Risk scales: lowest credit score of each class, best class first; the last name is the rest.
RISK_4 = [(750, "LOW"), (650, "MEDIUM"), (550, "HIGH"), (None, "VERY_HIGH")]
RISK_5 = [(750, "LOW"), (700, "MEDIUM_LOW"), (650, "MEDIUM"), (550, "HIGH"), (None, "VERY_HIGH")]
RISK_NAMED = [(750, "LOW_RISK"), (650, "MEDIUM_RISK"), (550, "HIGH_RISK"), (None, "VERY_HIGH_RISK")]

# Size scales: an amount above the limit falls in the class.
SIZE_4 = [(300_000, "JUMBO"), (100_000, "LARGE"), (25_000, "MEDIUM"), (None, "SMALL")]
SIZE_3 = [(100_000, "LARGE"), (25_000, "MEDIUM"), (None, "SMALL")]
VALUE_TIERS = [(10_000, "HIGH_VALUE"), (1_000, "MEDIUM_VALUE"), (None, "LOW_VALUE")]

# Days past due, upper end of each bucket.
DPD_BUCKETS = [
    (0, "CURRENT"),
    (30, "1-30 DPD"),
    (60, "31-60 DPD"),
    (90, "61-90 DPD"),
    (180, "91-180 DPD"),
    (None, "180+ DPD (Write-off candidate)"),
]

# Seconds between two equal payments, exclusive upper end of each confidence class.
DUPLICATE_CONFIDENCE = [(10, "HIGH_CONFIDENCE_DUPE"), (60, "LIKELY_DUPE"), (None, "POSSIBLE_DUPE")]

# Personal-data patterns (regular expressions that Java and RE2 read the same way).
PII_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "phone": r"\b[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}\b",
    "card": r"\b[0-9]{4}[- ][0-9]{4}[- ][0-9]{4}[- ][0-9]{4}\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
