"""Fixed values of the monitoring rules: labels, thresholds, constants.

They decide results, so they stand here together and in plain text. Functions
that use a threshold take it as a keyword argument with the value below.
"""

# Transaction types and the groups the rules put them in.
TYPES = ("PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT")
HIGH_RISK_TYPES = ("TRANSFER", "CASH_OUT")
OUTBOUND_TYPES = ("CASH_OUT", "TRANSFER", "DEBIT")
INBOUND_TYPES = ("CASH_IN", "PAYMENT")

# Amount limits; a label applies when the amount is above its limit.
TRANSFER_HIGH_LIMIT = 200_000
MEDIUM_LIMIT = 100_000
EMPTIED_LIMIT = 100_000
CUSTOMER_BANDS = ((500_000, "Platinum"), (100_000, "Gold"))
CUSTOMER_DEFAULT = "Standard"
# Here a label applies when the amount is below its limit.
SEGMENT_BANDS = ((1_000, "Retail"), (50_000, "Professional"), (500_000, "Institutional"))
SEGMENT_DEFAULT = "Ultra High Net Worth"

HIGH_RISK, MEDIUM_RISK, LOW_RISK = "High Risk", "Medium Risk", "Low Risk"
EMPTIED, NOT_EMPTIED = "Critical - Account Emptied", "Normal"
CATEGORY_HIGH, CATEGORY_LOW = "HIGH_RISK", "LOW_RISK"
TYPE_HIGH, TYPE_LOW = "High", "Low"
OUTBOUND, INBOUND, INTERNAL = "Outbound", "Inbound", "Internal"
MERCHANT_PREFIX = "M"

# Ledger audit.
EXACT_GAP, ROUNDING_GAP = "0.01", "1.00"
TIER_EXACT, TIER_ROUNDING = "A_PERFECT_LEDGER", "B_ROUNDING_ERROR"
TIER_GHOST, TIER_OTHER = "C_GHOST_TRANSFER", "D_SYSTEM_ANOMALY"

# Behaviour.
VELOCITY_STEPS, VELOCITY_LIMIT = 24, 3
VELOCITY_HIGH, VELOCITY_NORMAL = "High Velocity", "Normal"
RECENT_ROWS, VOLATILITY_ROWS = 10, 30
ANOMALY_FACTOR, SPIKE_FACTOR, VOLATILITY_FACTOR = 5, 3, 3
ANOMALY, NO_ANOMALY = "Abnormal", "Normal"
NEW_ACCOUNT_ROWS = 5
NEW_ACCOUNT, OLD_ACCOUNT = "New Account", "Established Account"
AUDIT_LIMIT = 2
AUDIT_FLAGGED, AUDIT_CLEAN = "Flagged for Audit", "Clean"
DRAIN_PERCENT = 90
INFANT_DAYS = 14
SESSION_MINUTES = 60
OUTLIER_Z, SANE_Z = 3, 50

# Risk weights.
TOTAL_WEIGHTS = {"emptied": 40, "anomaly": 30, "high_risk": 20, "round": 10}
INDEX_WEIGHTS = {"spike": 30, "new_account": 20, "emptied": 50}

# Gates, quarantine and audit notes.
NULL_RATIO_LIMIT = 0.10
STEP_LOW, STEP_HIGH = 1, 1000
REASON_KEY = "Missing Surrogate Key"
REASON_NO_AMOUNT = "Missing Amount"
REASON_AMOUNT = "Negative or Zero Amount"
REASON_ACCOUNT = "Missing Originator Identity"
REASON_OTHER = "Other Integrity Failure"
NOTE_BALANCE = "WARN: Balance increased during Transfer"
NOTE_STEP = "WARN: Step value outside simulation bounds"
NOTE_SEPARATOR = " | "
STATUS_NEW = "New"
FINGERPRINT_SEPARATOR = "||"

# Calendar.
CALENDAR_START, CALENDAR_STEPS = "2025-01-01", 744
LATE_NIGHT, STANDARD_HOURS = "Late Night", "Standard Hours"
MORNING, AFTERNOON, EVENING = "Morning", "Afternoon", "Evening"

# Feature table: values for nulls.
FEATURE_DEFAULTS = {
    "z_score": 0.0,
    "behavioral_spike_ratio": 1.0,
    "txns_last_24h": 0,
    "balance_drain_ratio": 0.0,
    "avg_last_10_txns": 0.0,
}

# Report.
REPORT_HIGH_LEVELS = ("HIGH", "CRITICAL")
