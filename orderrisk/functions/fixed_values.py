"""Fixed values. Results depend on these exact words, numbers and orders; change none of them."""

# --- Fixed values: card feed -------------------------------------------------------------------

CARD_FEED_DAY_ZERO = "2017-11-30"

DEFAULT_PAYMENT = "visa"

PRODUCT_BY_CODE = {
    "W": "Electronics",
    "C": "Clothing",
    "R": "Travel",
    "H": "Home & Garden",
    "S": "Services",
}
DEFAULT_PRODUCT = "Electronics"

COUNTRY_BY_ADDRESS_CODE = {
    87.0: "US",
    60.0: "MX",
    96.0: "CA",
    32.0: "GB",
    65.0: "AU",
    16.0: "DE",
    31.0: "FR",
    19.0: "JP",
    26.0: "BR",
    27.0: "IN",
}
DEFAULT_COUNTRY = "US"

US_EMAIL_DOMAINS = [
    "gmail.com",
    "yahoo.com",
    "hotmail.com",
    "aol.com",
    "comcast.net",
    "icloud.com",
    "outlook.com",
    "msn.com",
    "att.net",
    "live.com",
    "sbcglobal.net",
    "verizon.net",
    "ymail.com",
    "bellsouth.net",
    "cox.net",
    "charter.net",
    "earthlink.net",
    "anonymous.com",
]

# The first suffix that fits decides.
COUNTRY_BY_EMAIL_SUFFIX = {
    ".co.uk": "GB",
    ".uk": "GB",
    ".de": "DE",
    ".fr": "FR",
    ".ru": "RU",
    ".cn": "CN",
    ".jp": "JP",
    ".au": "AU",
    ".ca": "CA",
    ".br": "BR",
    ".mx": "MX",
    ".in": "IN",
}

# --- Fixed values: accepted words ---------------------------------------------------------------

PAYMENT_METHODS = ["visa", "mastercard", "discover", "american express"]
PRODUCT_CATEGORIES = ["Electronics", "Clothing", "Travel", "Home & Garden", "Services"]
RISK_TIERS = ["none", "low", "medium", "high"]
FRAUD_FLAGS = [0, 1]

# --- Fixed values: scoring ----------------------------------------------------------------------

FLAG_AT = 50
TIER_FLOORS = [(80, "high"), (50, "medium"), (25, "low")]
LOWEST_TIER = "none"
MAX_SCORE = 165
HIGH_VELOCITY_ORDERS = 3

# --- Fixed values: rule labels in the report, the exploratory table and the coverage check -------

REPORT_RULE_LABELS = {
    "ip_mismatch": "IP mismatch (IP != billing country)",
    "country_mismatch": "Country mismatch (billing != shipping)",
    "high_amount": "High order amount (>=150)",
    "new_customer_high_amount": "New customer + high amount (>=100)",
    "high_velocity": "High velocity (3+ orders/day)",
    "new_account": "New account (age < 30 days)",
    "travel": "Travel category purchase",
    "late_night": "Late-night order (1am-5am)",
}

EXPLORE_RULE_LABELS = {
    "high_amount": "high_amount (>=150)",
    "country_mismatch": "country_mismatch",
    "high_velocity": "high_velocity",
    "travel": "travel_category",
    "new_customer_high_amount": "new_cust_high_amt",
    "late_night": "late_night (1-5am)",
    "ip_mismatch": "ip_mismatch",
    "new_account": "new_account (<30d)",
}

COVERAGE_RULE_LABELS = {
    "high_amount": "High order amount (>=150)",
    "country_mismatch": "Country mismatch",
    "ip_mismatch": "IP mismatch",
    "high_velocity": "High velocity (3+ orders/day)",
    "gift_cards": "Gift card purchase",
    "new_customer_high_amount": "New customer + high amount",
    "new_customer_crypto": "New customer + crypto",
    "late_night": "Late-night order (1am-5am)",
}

# --- Fixed values: boundary cases of the variant rules (overrides, expected score, flag) ----------

BOUNDARY_BASE = {
    "order_date": "2024-06-01",
    "order_hour": 12,
    "order_amount": 50.0,
    "payment_method": "credit_card",
    "product_category": "clothing",
    "billing_country": "US",
    "shipping_country": "US",
    "ip_country": "US",
    "is_new_customer": False,
    "account_age_days": 365,
}

BOUNDARY_CASES = [
    ({}, 0, 0),
    ({"order_amount": 149.99}, 0, 0),
    ({"order_amount": 150.00}, 20, 0),
    ({"shipping_country": "CA"}, 25, 0),
    ({"ip_country": "NG"}, 25, 0),
    ({"shipping_country": "CA", "ip_country": "NG"}, 50, 1),
    ({"is_new_customer": True, "payment_method": "crypto"}, 30, 0),
    ({"is_new_customer": True, "payment_method": "crypto", "product_category": "gift_cards"}, 45, 0),
    (
        {
            "is_new_customer": True,
            "payment_method": "crypto",
            "product_category": "gift_cards",
            "order_amount": 150.0,
        },
        85,
        1,
    ),
    ({"order_hour": 3, "shipping_country": "GB"}, 35, 0),
]

# --- Fixed values: report and exploration ---------------------------------------------------------

METRIC_NAMES = [
    "roc_auc",
    "avg_precision",
    "fraud_f1",
    "baseline_auc",
    "baseline_ap",
    "baseline_f1",
]
MISSING_METRIC = "N/A"
TOP_FLAGGED = 50

EXPORT_HEADERS = [
    "Order ID",
    "Customer",
    "Date",
    "Amount",
    "Payment",
    "Category",
    "Billing",
    "Shipping",
    "IP Country",
    "ML Prob",
    "Risk Score",
    "Tier",
]

AGE_BUCKETS = [
    ("<7d", 0, 7),
    ("7-30d", 7, 30),
    ("30-90d", 30, 90),
    ("90-180d", 90, 180),
    ("180d-1y", 180, 365),
    ("1y+", 365, None),
]

AMOUNT_CLIP = 1000.0
AMOUNT_BINS = 60
SCORE_BINS = 30

CORRELATION_COLUMNS = [
    "order_amount",
    "order_hour",
    "account_age_days",
    "orders_on_day",
    "customer_avg_order_amount",
    "customer_ip_mismatch_count",
    "risk_score",
    "is_fraud",
]

# --- Fixed values: model inputs and published baseline ---------------------------------------------

NUMERIC_FEATURES = [
    "order_amount",
    "order_hour",
    "account_age_days",
    "orders_on_day",
    "customer_avg_order_amount",
    "customer_ip_mismatch_count",
]
BOOLEAN_FEATURES = ["is_new_customer", "country_mismatch", "ip_mismatch", "high_velocity"]
CATEGORY_FEATURES = {
    "payment_method": PAYMENT_METHODS,
    "product_category": PRODUCT_CATEGORIES,
}

BASELINE_LABEL = "-- rule-based baseline --"
BASELINE_METRICS = {"baseline_auc": 0.631, "baseline_ap": 0.052, "baseline_f1": 0.093}

MODEL_FLAG_AT = 0.5
TEST_SHARE = (1, 5)
EXPLAIN_SAMPLE = 5000
SMOTE_NEIGHBOURS = 5
PERMUTATION_REPEATS = 5
