"""Canonical shop tables derived from the driver's TPC-H-style tables.

customer -> users, orders (+ lineitem discounts) -> orders, lineitem ->
order_items, part -> products, events -> browse_events and (sessionised)
sessions.  Every frame is lazy and reads only the columns it needs, so the
parquet scans get column pruning and pushed filters from Catalyst.
The oracle SQL spells the same derivations as DuckDB CTEs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.functions.dates import shift_days
from shoplens.operators.sessionize import assign_sessions, sessionize

# ---------------------------------------------------------------------------
# Fixed values of the adapter (how driver codes map onto shop domains).
# ---------------------------------------------------------------------------
EVENT_SHIFT_DAYS = -8232  # January 2024 events land on both sides of 2 July 2001, 30 days before the last order
SESSION_GAP_SECONDS = 6 * 3600
SEGMENT_TO_MEMBERSHIP = {
    "AUTOMOBILE": "free",
    "MACHINERY": "free",
    "BUILDING": "silver",
    "FURNITURE": "gold",
    "HOUSEHOLD": "platinum",
}
ORDERSTATUS_TO_STATUS = {"F": "delivered", "O": "processing", "P": "shipped"}
PRIORITY_TO_PAYMENT = {
    "1-URGENT": "credit_card",
    "2-HIGH": "debit_card",
    "3-MEDIUM": "paypal",
    "4-NOT SPECIFIED": "upi",
    "5-LOW": "wallet",
}
EVENT_TYPE_MAP = {
    "view": "view",
    "click": "click",
    "purchase": "add_to_cart",
    "signup": "add_to_wishlist",
    "error": "remove_from_cart",
}
DEVICE_BY_NATION_MOD3 = ["mobile", "tablet", "desktop"]
GENDER_BY_KEY_MOD3 = ["Male", "Female", "Other"]
NO_ORDER_SIGNUP_BASE = "2001-08-01"
URGENT_PRIORITY = "1-URGENT"
# ---------------------------------------------------------------------------

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _case(c: Column, mapping: dict) -> Column:
    """CASE c WHEN k1 THEN v1 ... END (unmatched values give null)."""
    out = None
    for k, v in mapping.items():
        out = F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v))
    return out


def _pick(c: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (c % len(values) + 1).cast("int"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_order = (
        raw(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("_first"))
    )
    c = raw(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    base = F.to_date(F.coalesce(F.col("_first").cast("timestamp"), F.lit(NO_ORDER_SIGNUP_BASE).cast("timestamp")))
    return c.join(first_order, c.c_custkey == first_order.o_custkey, "left").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("user"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        (F.lit(18) + F.col("c_custkey") % 53).cast("int").alias("age"),
        _pick(F.col("c_custkey"), GENDER_BY_KEY_MOD3).alias("gender"),
        F.lit(None).cast("string").alias("city"),
        F.col("c_nationkey").cast("string").alias("state"),
        _pick(F.col("c_nationkey"), DEVICE_BY_NATION_MOD3).alias("device_type"),
        _case(F.col("c_mktsegment"), SEGMENT_TO_MEMBERSHIP).alias("membership"),
        F.date_sub(base, (F.col("c_custkey") % 400).cast("int")).alias("signup_date"),
    )


def orders(spark: SparkSession, sf_dir: str, with_discount: bool = True) -> DataFrame:
    o = raw(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_date"),
        F.col("o_totalprice").alias("total_amount"),
        _case(F.col("o_orderstatus"), ORDERSTATUS_TO_STATUS).alias("status"),
        _case(F.col("o_orderpriority"), PRIORITY_TO_PAYMENT).alias("payment_method"),
        F.col("o_orderpriority").alias("priority"),
    )
    if not with_discount:
        return o.withColumn("discount_pct", F.lit(None).cast("int"))
    disc = (
        raw(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(
            F.floor(F.sum(F.round(F.col("l_discount") * 100)) / F.count(F.lit(1)))
            .cast("int")
            .alias("_disc")
        )
    )
    return o.join(disc, "order_id", "left").withColumn(
        "discount_pct", F.coalesce(F.col("_disc"), F.lit(0))
    ).drop("_disc")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "order_item_id"
        ),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")), 2).alias("unit_price"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").alias("stock_qty"),
    )


def browse_events(spark: SparkSession, sf_dir: str, with_session: bool = False) -> DataFrame:
    """Events as browse events.  ``event_ts`` (shifted) is kept for windowed
    variants; ``session_id`` is attached only on request (it costs a join)."""
    e = raw(spark, sf_dir, "events").select(
        F.col("event_id"),
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("long").alias("product_id"),
        _case(F.col("event_type"), EVENT_TYPE_MAP).alias("event_type"),
        F.col("value").alias("time_spent_secs"),
        shift_days("ts", EVENT_SHIFT_DAYS).alias("event_ts"),
    )
    if with_session:
        e = assign_sessions(e, "user_id", "event_ts", "event_id", SESSION_GAP_SECONDS)
    return e


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = raw(spark, sf_dir, "events").select(
        "event_id", "user_id", shift_days("ts", EVENT_SHIFT_DAYS).alias("event_ts")
    )
    return sessionize(e, "user_id", "event_ts", "event_id", SESSION_GAP_SECONDS)


def canonical_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "users": users(spark, sf_dir),
        "products": products(spark, sf_dir),
        "sessions": sessions(spark, sf_dir),
        "browse_events": browse_events(spark, sf_dir),
        "orders": orders(spark, sf_dir),
        "order_items": order_items(spark, sf_dir),
    }
