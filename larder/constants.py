"""Fixed values.

Everything in the first block must equal the behaviour being reproduced for
results to match (label lists, keyword rules, tier limits, stock constants,
window lengths, table names).  The second block is the test-fixture mapping
of the supplied TPC-H-style tables to the retail shape (see FIXTURES.md).
All of these are defaults of function arguments, never hard-wired in logic.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES — pipeline semantics
# ---------------------------------------------------------------------------

RAW_ENTITIES = [
    "orders",
    "order_products_prior",
    "order_products_train",
    "products",
    "aisles",
    "departments",
]

RAW_FILE_NAMES = {
    "orders": "orders.csv",
    "order_products_prior": "order_products__prior.csv",
    "order_products_train": "order_products__train.csv",
    "products": "products.csv",
    "aisles": "aisles.csv",
    "departments": "departments.csv",
}

LAYER_DATABASES = {"bronze": "grocery_bronze", "silver": "grocery_silver", "gold": "grocery_gold"}

# Tables that the maintenance step compacts, and those it clusters.
COMPACTED_TABLES = [
    "grocery_gold.daily_product_demand", "grocery_gold.reorder_metrics", "grocery_gold.stockout_risk",
    "grocery_gold.overstock_alerts", "grocery_gold.basket_affinity",
]
CLUSTERED_TABLES = {
    "grocery_gold.daily_product_demand": ["product_id", "department"],
    "grocery_gold.reorder_metrics": ["product_id", "department"],
}

VALIDATION_TABLES = [
    "grocery_bronze.bronze_orders",
    "grocery_bronze.bronze_order_products_prior",
    "grocery_bronze.bronze_order_products_train",
    "grocery_bronze.bronze_products",
    "grocery_bronze.bronze_aisles",
    "grocery_bronze.bronze_departments",
    "grocery_silver.dim_product",
    "grocery_silver.dim_product_ai",
    "grocery_silver.dim_aisle",
    "grocery_silver.dim_department",
    "grocery_silver.fact_order_products",
    "grocery_silver.fact_inventory_snapshots",
    "grocery_silver.quarantine_malformed_products",
    "grocery_gold.daily_product_demand",
    "grocery_gold.reorder_metrics",
    "grocery_gold.stockout_risk",
    "grocery_gold.overstock_alerts",
    "grocery_gold.basket_affinity",
]

QUARANTINE_REASON = "Invalid numeric key in product source"

PRODUCT_THEMES = [
    "fresh_produce", "dairy_and_eggs", "meat_and_seafood", "frozen_food", "beverages",
    "snacks", "bakery", "pantry_staples", "health_and_wellness", "household",
    "baby_and_kids", "pet_supplies", "personal_care", "other",
]

DEMAND_TYPES = [
    "essential", "impulse", "premium", "seasonal", "convenience",
    "health_focused", "budget_friendly", "other",
]

# Theme rule on lower(department): literal substring, first match wins.
THEME_RULES = [
    ("produce", "fresh_produce"),
    ("dairy", "dairy_and_eggs"),
    ("meat", "meat_and_seafood"),
    ("frozen", "frozen_food"),
    ("beverages", "beverages"),
    ("snacks", "snacks"),
    ("bakery", "bakery"),
    ("household", "household"),
    ("babies", "baby_and_kids"),
    ("pets", "pet_supplies"),
    ("personal care", "personal_care"),
]
THEME_DEFAULT = "other"

# Demand-type rule on lower(product_name): unanchored regex, first match wins.
DEMAND_RULES = [
    ("organic|protein|gluten|keto|vegan|plant|non-gmo", "health_focused"),
    ("premium|reserve|artisan|specialty|gourmet", "premium"),
    ("snack|chips|cookie|candy|chocolate|popcorn", "impulse"),
    ("family|value|bulk|large|party", "budget_friendly"),
    ("frozen|ready|instant|microwave|quick", "convenience"),
]
DEMAND_DEFAULT = "essential"

MODEL_SAMPLE_SIZE = 1000
METHOD_MODEL = "keyword_tfidf_model"
METHOD_RULES = "rule_based_fallback"

SHORT_WINDOW = 7      # rowsBetween(-7, 0): 8 rows
LONG_WINDOW = 30      # rowsBetween(-30, 0): 31 rows, divided by 30

INITIAL_INVENTORY = 500
RESTOCK_EVERY = 10
RESTOCK_QTY = 250
REORDER_POINT = 50

# (tier, upper limit on days_of_stock_proxy, priority score); STOCKOUT first.
STOCKOUT_TIERS = [("CRITICAL", 3, 80), ("HIGH", 7, 60), ("MEDIUM", 14, 40)]
STOCKOUT_SCORE = 100
STOCKOUT_OK_SCORE = 10
# (tier, lower limit on days_of_stock_proxy); NORMAL rows are dropped.
OVERSTOCK_TIERS = [("SEVERE_OVERSTOCK", 120), ("HIGH_OVERSTOCK", 90), ("MODERATE_OVERSTOCK", 60)]
NO_DEMAND_PROXY = 999

MIN_CO_PURCHASE = 10
HIGH_RISK_TIERS = ["STOCKOUT", "CRITICAL", "HIGH"]

# Dashboards: digits shown, least units, lengths of the top lists.
RATE_DIGITS = 4
STOCK_DIGITS = 2
NO_LABEL = "unclassified"
TOP_REORDERED_LEAST_UNITS = 100
TOP_REORDERED = 25
TOP_PRIORITY = 50
TOP_PAIRS = 50

# Keyword tables of the label-scoring job (input data of classify_labels).
THEME_KEYWORDS = {
    "fresh_produce": "organic fresh spinach eggplant apple banana salad",
    "dairy_and_eggs": "milk yogurt cheese butter egg eggs cream",
    "meat_and_seafood": "beef chicken pork fish salmon",
    "frozen_food": "frozen ice microwave",
    "beverages": "juice water tea coffee soda",
    "snacks": "chips popcorn chocolate bar cookie",
    "bakery": "bread rye bagel cake",
    "pantry_staples": "rice oats flour pasta preserves",
    "health_and_wellness": "protein vegan vitamin",
    "household": "bags cleaner paper",
    "baby_and_kids": "baby kids diaper",
    "pet_supplies": "dog cat pet",
    "personal_care": "soap shampoo lotion",
}
DEMAND_KEYWORDS = {
    "essential": "milk bread rice eggs water flour",
    "impulse": "chips candy chocolate popcorn cookie snack",
    "premium": "gourmet artisan premium reserve specialty preserves",
    "seasonal": "pumpkin holiday cranberry eggnog",
    "convenience": "microwave meal instant quick ready frozen",
    "health_focused": "organic vegan protein gluten keto yogurt",
    "budget_friendly": "family pack value bulk party large",
}
LABEL_SCORE_DIGITS = 9

# ---------------------------------------------------------------------------
# FIXED VALUES — test fixture mapping (FIXTURES.md §2)
# ---------------------------------------------------------------------------

FIXTURE_PRODUCT_MODULUS = 450      # at least; more where there are more parts
FIXTURE_PARTS_PER_MODULUS = 10
QUERY_SAMPLE_SIZE = 100          # of the registered queries, so that both labelling methods occur
QUERY_LANDING_FILES = 4
QUERY_PREVIEW_ROWS = 5
QUERY_MALFORMED_MOD = 10         # product lines: 3 too many fields, 7 too few, 5 landed under another header
QUERY_LONG_REM, QUERY_SHORT_REM, QUERY_OTHER_HEADER_REM = 3, 7, 5
QUERY_OTHER_HEADER = "id,name,aisle,department"
QUERY_RENAMED, QUERY_KEYLESS_NAME = "renamed ", "no key"  # products of the second landing (their rem: 3); a row in both
QUERY_MISSING_ENTITY = "aisles"  # the one that the landing report's input lacks
QUERY_ABSENT_TABLE = "grocery_gold.absent"
QUERY_UNREADABLE_TABLE = "grocery_bronze.unreadable"
FIXTURE_LARGE_ID_MOD = 5         # every fifth order has an id beyond 32 bits
FIXTURE_LARGE_ID_ADD = 3_000_000_000
FIXTURE_BAD_LINE_MOD = 100       # text lines: 1 bad order id, 2 bad product id, 3 no product id
FIXTURE_PRODUCT_NAMES = [
    "Organic Spinach", "Whole Milk", "Artisan Rye", "Potato Chips", "Family Pack Rice",
    "Microwave Meal", "Eggplant", "Strawberry Preserves", "Plain Yogurt", "Vegan Protein Bar",
    "Gourmet Chocolate", "Quick Oats", "Party Popcorn",
]
FIXTURE_DEPARTMENTS = [
    "produce", "dairy eggs", "meat seafood", "frozen", "beverages", "snacks",
    "bakery", "household", "babies", "pets", "personal care", "pantry",
]
FIXTURE_AISLE_COUNT = 20
FIXTURE_BAD_AISLE = "30 large"   # a product row whose CSV columns shifted
FIXTURE_BAD_AISLE_MOD = 97
FIXTURE_BAD_AISLE_REM = 60
