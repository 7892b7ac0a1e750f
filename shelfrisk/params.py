"""Business parameters of the stock-risk pipeline.

Every threshold, window, valid set and format is a parameter of the
operator that uses it; this module only holds the defaults.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must equal the reference pipeline's for equal results.
#   stock threshold 10 (stock_qty < 10), demand threshold 5 (sales_7d > 5)
#   trailing windows of 7 and 30 days, lower bound inclusive
#   valid rating range 1..5, both ends inclusive
#   valid event types: view, cart, wishlist
#   date format of the raw sources: yyyy-MM-dd (ISO); repair format dd/MM/yyyy
#   inventory timestamp format: yyyy-MM-dd'T'HH:mm:ss
#   split: default test size 0.2, cap 0.5, at least 1 minority row in test, seed 42
#   forest: 100 trees, seed 42, balanced class weights
# ---------------------------------------------------------------------------
STOCK_THRESHOLD = 10
DEMAND_THRESHOLD = 5
SHORT_WINDOW_DAYS = 7
LONG_WINDOW_DAYS = 30
RATING_MIN = 1
RATING_MAX = 5
VALID_EVENT_TYPES = ("view", "cart", "wishlist")
ISO_DATE = "yyyy-MM-dd"
DAY_FIRST_DATE = "dd/MM/yyyy"
ISO_DATETIME = "yyyy-MM-dd'T'HH:mm:ss"
DEFAULT_TEST_SIZE = 0.2
MAX_TEST_SIZE = 0.5
MIN_POSITIVE_IN_TEST = 1
SEED = 42
NUM_TREES = 100

# Key and null-check columns of the quality report, per dataset (fixed values).
QUALITY_KEYS = {
    "orders": ["order_id", "product_id", "store_id"],
    "products": ["product_id"],
    "stores": ["store_id"],
    "inventory": ["product_id", "store_id"],
    "reviews": ["review_id", "product_id"],
    "events": ["event_id", "product_id"],
}

# Final column order of the fact table (fixed values).
FACT_COLUMNS = [
    "product_id", "store_id", "sales_7d", "sales_30d", "avg_rating",
    "stock_qty", "category", "region", "web_signal", "stockout_risk",
]

# Features the classifier sees once ids and label are dropped.
ID_COLUMNS = ["product_id", "store_id"]
LABEL = "stockout_risk"

# Non-negative columns asserted on the fact table (fixed values).
NON_NEGATIVE_COLUMNS = ["sales_7d", "sales_30d", "stock_qty", "web_signal"]

# Event types present in the driver's `events` table that play the role of
# the reference's web-demand events (view / add-to-cart / wishlist).
DRIVER_EVENT_TYPES = ("view", "click", "purchase")

# Month partition column the ETL adds when it lands a cleaned time-series
# table: dataset -> (partition column, timestamp column).  Trailing-window
# filters repeat themselves on that column so the scan prunes partitions
# (a 30-day window touches at most two months).
TIME_PARTITIONS = {"orders": ("order_month", "order_date"), "events": ("event_month", "event_ts")}
