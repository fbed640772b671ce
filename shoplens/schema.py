"""Declared schemas and value domains of the six canonical shop tables.

Readers apply these schemas; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must match the original application's definitions.
# ---------------------------------------------------------------------------
MEMBERSHIP_ORDER = ["free", "silver", "gold", "platinum"]
STATUS_ORDER = ["cancelled", "returned", "processing", "shipped", "delivered"]
DEVICE_CODES = {"mobile": 0, "tablet": 1, "desktop": 2}
MEMBERSHIP_CODES = {"free": 0, "silver": 1, "gold": 2, "platinum": 3}
PREMIUM_TIERS = ["gold", "platinum"]
SEGMENTS = ["Champions", "Loyal", "Recent", "At Risk", "Lost", "Potential"]
# ---------------------------------------------------------------------------

USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("gender", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("membership", T.StringType()),
        T.StructField("signup_date", T.DateType()),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("subcategory", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("review_count", T.IntegerType()),
        T.StructField("stock_qty", T.IntegerType()),
        T.StructField("is_featured", T.BooleanType()),
    ]
)

SESSIONS = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_start", T.TimestampType()),
        T.StructField("session_end", T.TimestampType()),
        T.StructField("duration_secs", T.LongType()),
        T.StructField("device", T.StringType()),
        T.StructField("referral_source", T.StringType()),
        T.StructField("pages_visited", T.IntegerType()),
        T.StructField("bounced", T.BooleanType()),
    ]
)

BROWSE_EVENTS = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("time_spent_secs", T.DoubleType()),
        T.StructField("event_sequence", T.IntegerType()),
    ]
)

ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("order_date", T.TimestampType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("discount_pct", T.IntegerType()),
    ]
)

ORDER_ITEMS = T.StructType(
    [
        T.StructField("order_item_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DoubleType()),
    ]
)

TABLES = {
    "users": USERS,
    "products": PRODUCTS,
    "sessions": SESSIONS,
    "browse_events": BROWSE_EVENTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
}

DATETIME_COLUMNS = {
    "sessions": ["session_start", "session_end"],
    "orders": ["order_date"],
    "users": ["signup_date"],
}

# Columns of a user that enter the feature matrix (fixed values, in order);
# a name that ends in * stands for all that start with it.
USER_FEATURES = ["user_id", "age", "account_age_days", "will_purchase", "membership_encoded", "is_premium",
                 "gender_*", "device_*"]
# Days after signup below which a user is new, and above which a veteran.
NEW_USER_DAYS, VETERAN_DAYS = 30, 365
