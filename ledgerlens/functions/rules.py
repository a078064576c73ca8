"""The business rules as data: two profiles, one set of column names.

Everything in this module is a fixed value that results depend on; the
expressions that apply them live in ``bands``, ``encode`` and ``scores``.
"""

# Column lists of the two inputs, in table order.
EXPENSES = (
    "rent", "loan_repayment", "insurance", "groceries", "transport", "eating_out",
    "entertainment", "utilities", "healthcare", "education", "miscellaneous",
)
POTENTIAL_SAVINGS = (
    "potential_savings_groceries", "potential_savings_transport",
    "potential_savings_eating_out", "potential_savings_entertainment",
    "potential_savings_utilities", "potential_savings_healthcare",
    "potential_savings_education", "potential_savings_miscellaneous",
)
SAVINGS = ("desired_savings_percentage", "desired_savings", "disposable_income")
FINANCE_NUMERIC = ("income",) + EXPENSES + SAVINGS + POTENTIAL_SAVINGS
FINANCE_COLUMNS = (
    ("id", "income", "age", "dependents", "occupation", "city_tier")
    + EXPENSES + SAVINGS + POTENTIAL_SAVINGS
)
PAYMENT_COLUMNS = (
    "transaction_id", "timestamp", "transaction_type", "merchant_category", "amount_inr",
    "transaction_status", "sender_age_group", "receiver_age_group", "sender_state",
    "sender_bank", "receiver_bank", "device_type", "network_type", "fraud_flag",
    "hour_of_day", "day_of_week", "is_weekend",
)
PAYMENT_TEXT = (
    "transaction_type", "merchant_category", "transaction_status", "sender_age_group",
    "receiver_age_group", "sender_state", "sender_bank", "receiver_bank", "device_type",
    "network_type", "day_of_week",
)

# Age bands (low, high, range label, category). high None = open.
AGE_BANDS = (
    (18, 25, "18-25", "Teenagers"),
    (26, 35, "26-35", "Young Adult"),
    (36, 45, "36-45", "Early Middle Age"),
    (46, 55, "46-55", "Late Middle Age"),
    (56, None, "56+", "Seniors"),
)
UNKNOWN = "Unknown"

# Label codes. The two profiles number occupations differently.
OCCUPATION_CODES = {
    "elt": {"self_employed": 1, "professional": 2, "retired": 3, "student": 4},
    "etl": {"self_employed": 1, "retired": 2, "student": 3, "professional": 4, "unknown": 0},
}
CITY_TIER_CODES = {
    "elt": {"tier_1": 1, "tier_2": 2, "tier_3": 3},
    "etl": {"tier_1": 1, "tier_2": 2, "tier_3": 3, "unknown": 0},
}
OCCUPATION_GROUPS = {
    "Working": ("self_employed", "professional"),
    "Retired": ("retired",),
    "Student": ("student",),
}
STATUS_CODES = {"SUCCESS": 1, "FAILED": 0}
DEVICE_CODES = {"android": 1, "ios": 2, "web": 3}
NETWORK_CODES = {"5g": 4, "4g": 3, "wifi": 2, "3g": 1}

# Merchant and transaction groupings.
MERCHANT_GROUPS = {
    "Food & Groceries": ("food", "grocery", "eating_out"),
    "Leisure": ("entertainment", "shopping"),
    "Transportation": ("fuel", "transport"),
    "Health & Insurance": ("healthcare", "insurance"),
    "Education": ("education",),
    "Utilities & Bills": ("utilities", "bill payment", "recharge"),
}
ESSENTIAL_MERCHANTS = ("food", "grocery", "healthcare", "utilities", "fuel", "education")
TRANSACTION_TYPES = {
    "p2p": "Person to Person", "p2m": "Person to Merchant",
    "bill payment": "Bill Payment", "recharge": "Recharge",
}
WEEKEND_UPLIFT_MERCHANTS = ("food", "entertainment", "shopping")
# merchant -> the person's savings potential that belongs to it (etl profile)
MERCHANT_SAVINGS = {
    "groceries": "potential_savings_groceries",
    "transport": "potential_savings_transport",
    "food": "potential_savings_eating_out",
    "entertainment": "potential_savings_entertainment",
}

# Normalisation bounds, outlier limit, missing-text defaults.
FIXED_BOUNDS = {
    "income": (5000, 150000),
    "disposable_income": (-10000, 80000),
    "amount_inr": (10, 50000),
}
MAX_AMOUNT = 100000
OUTLIER_COLUMNS = ("income", "rent", "loan_repayment", "insurance", "groceries")
FINANCE_TEXT_DEFAULTS = {"occupation": "Unknown", "city_tier": "Unknown"}
PAYMENT_TEXT_DEFAULTS = {
    "transaction_type": "unknown", "merchant_category": "other",
    "transaction_status": "unknown", "sender_age_group": "unknown",
    "receiver_age_group": "unknown", "sender_state": "unknown",
    "device_type": "unknown", "network_type": "unknown",
}

# The quality rules of the etl run.
QUALITY_RULES = {
    "unique": ("transaction_id",),
    "ranges": {"amount": (0, 100000), "age": (18, 100), "income": (0, 500000)},
    "types": {"amount": "double", "age": "int", "income": "double"},
    "distributions": ("amount", "income", "disposable_income"),
}
