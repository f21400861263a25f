"""Domain values of the payments data model.

FIXED VALUES: these lists and maps must equal the ones the original platform
uses, so they are written out plainly and in their natural order.
"""

# --- fixed values -----------------------------------------------------------
CURRENCIES = ["USD", "EUR", "GBP", "JPY", "CHF"]
COUNTRIES = ["US", "FR", "DE", "GB", "JP", "ES", "IT", "NL"]
CATEGORIES = ["ecommerce", "saas", "marketplace", "retail", "travel"]
DEVICES = ["mobile", "desktop", "tablet"]
STATUSES = ["success", "failed", "refunded", "pending"]
HIGH_RISK_COUNTRIES = ["US", "RU", "CN", "BR", "NG"]
REQUIRED_EVENT_KEYS = ["id", "customer_id", "merchant_id", "amount", "currency_code"]
AUDIT_OPERATIONS = ["INSERT", "UPDATE", "DELETE"]

CURRENCY_ROWS = [
    ("USD", "US Dollar"),
    ("EUR", "Euro"),
    ("GBP", "British Pound"),
    ("JPY", "Japanese Yen"),
    ("CHF", "Swiss Franc"),
]
COUNTRY_ROWS = [
    ("US", "United States", "Americas"),
    ("FR", "France", "Europe"),
    ("DE", "Germany", "Europe"),
    ("GB", "United Kingdom", "Europe"),
    ("JP", "Japan", "Asia"),
    ("ES", "Spain", "Europe"),
    ("IT", "Italy", "Europe"),
    ("NL", "Netherlands", "Europe"),
]
PAYMENT_METHOD_ROWS = [(1, "card"), (2, "bank_transfer"), (3, "wallet")]

ISO_ALPHA3 = {
    "US": "USA", "FR": "FRA", "DE": "DEU",
    "GB": "GBR", "JP": "JPN", "ES": "ESP",
    "IT": "ITA", "NL": "NLD", "RU": "RUS",
    "CN": "CHN", "BR": "BRA", "NG": "NGA",
}

FRAUD_THRESHOLD = 0.7          # fraud_score > 0.7 means "suspected"
HIGH_RISK_BAND = 0.7           # probability > 0.7  -> HIGH
MEDIUM_RISK_BAND = 0.4         # probability > 0.4  -> MEDIUM
DECISION_THRESHOLD = 0.5       # probability > 0.5  -> is_fraud

# Rule score, in basis points (1 bp = 0.0001).
RULE_AMOUNT_TIERS = [(4000, 3500), (2000, 2000), (1000, 1000)]
RULE_HIGH_RISK_COUNTRY_BP = 2000
RULE_NIGHT_BP = 1500
RULE_MOBILE_BP = 1000
RULE_FAILED_BP = 1500
NIGHT_START_HOUR = 22          # night: hour >= 22 or hour <= 6
NIGHT_END_HOUR = 6

# Defaults for scoring records that lack a field.
SCORING_DEFAULTS = {
    "device_type": "desktop",
    "ip_country": "US",
    "status": "success",
    "fraud_score": 0.0,
}

FEATURE_COLUMNS = [
    "amount", "amount_log", "is_high_amount",
    "device_mobile", "device_desktop", "device_tablet",
    "status_success", "status_failed", "status_refunded",
    "hour", "day_of_week", "is_weekend", "is_night",
    "high_risk_country",
]
LABEL_COLUMN = "is_fraud"

# Forest parameters of the production model.
FOREST_PARAMS = {
    "numTrees": 200,
    "maxDepth": 10,
    "minInstancesPerNode": 2,
    "seed": 42,
}
TEST_FRACTION = 0.2
CV_FOLDS = 5
SPLIT_SEED = 42
