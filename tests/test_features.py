"""Feature operators: properties over seeded fixtures (one row per user,
rates in [0, 1], frequency cap, segments, users survive the joins)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from shoplens.operators import features as FE
from shoplens.operators import rfm as RFM
from shoplens.schema import SEGMENTS


@pytest.fixture()
def tables(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    sessions = spark.createDataFrame(
        [(f"S{i}", f"U{i % 3}", base + dt.timedelta(hours=3 * i), float(rnd.randint(10, 900)),
          float(rnd.randint(1, 20)), i % 2, round(rnd.random(), 4)) for i in range(30)],
        "session_id string, user_id string, session_start timestamp, duration_secs_clean double, "
        "pages_visited_clean double, bounced int, engagement_score double",
    )
    events = spark.createDataFrame(
        [(f"E{i}", f"S{i % 30}", f"U{i % 3}", f"P{i % 3}", rnd.choice(["view", "add_to_cart", "add_to_wishlist"]),
          float(rnd.randint(1, 300))) for i in range(60)],
        "event_id string, session_id string, user_id string, product_id string, event_type string, "
        "time_spent_secs_clean double",
    ).withColumn("added_to_cart", (F.col("event_type") == "add_to_cart").cast("int")).withColumn(
        "wishlisted", (F.col("event_type") == "add_to_wishlist").cast("int"))
    orders = spark.createDataFrame(
        [(f"O{i}", f"U{i % 2}", base + dt.timedelta(days=15 * i), float(rnd.randint(10, 500)), rnd.choice([0, 5, 10]),
          "delivered") for i in range(15)],
        "order_id string, user_id string, order_date timestamp, total_amount double, discount_pct int, status string",
    )
    products = spark.createDataFrame([(f"P{i}", f"C{i}", 10.0 * i) for i in range(5)],
                                     "product_id string, category string, price double")
    users = spark.createDataFrame(
        [("U0", 30, "gold", 2, 1, 400, 1), ("U1", 40, "free", 0, 0, 10, 1), ("U2", 50, "silver", 1, 0, 100, 0)],
        "user_id string, age int, membership string, membership_encoded int, is_premium int, account_age_days int, "
        "will_purchase int",
    )
    return {"sessions": sessions, "browse_events": events, "orders": orders, "products": products, "users": users}


def test_session_features_one_row_per_user(spark, tables):
    snap = FE.default_snapshot(tables["orders"])
    s = FE.create_session_features(tables["sessions"], snap)
    assert s.count() == s.select("user_id").distinct().count() == 3
    assert {"duration_secs_clean_mean", "total_sessions", "days_since_last_session"} <= set(s.columns)


def test_browse_rates_and_categories(spark, tables):
    b = FE.create_browse_features(tables["browse_events"], tables["products"]).collect()
    assert all(0 <= r.cart_add_rate <= 1 and 0 <= r.wishlist_rate <= 1 for r in b)
    assert all(r.unique_categories_browsed >= 1 for r in b)
    assert all(r.view_to_cart_ratio == r.cart_add_rate for r in b)


def test_order_frequency_capped(spark, tables):
    extra = spark.createDataFrame(
        [("X1", "U0", dt.datetime(2024, 1, 1), 10.0, 0, "delivered"),
         ("X2", "U0", dt.datetime(2024, 1, 2), 10.0, 0, "delivered")],
        tables["orders"].schema,
    )
    o = tables["orders"].unionByName(extra)
    f = FE.create_order_features(o, FE.default_snapshot(o)).collect()
    assert all(r.order_frequency <= 30 for r in f)
    assert all(r.customer_lifespan_days >= 1 for r in f)


def test_cutoff_label_only_past_buyers(spark, tables):
    f = FE.create_order_features(tables["orders"], None, cutoff="2024-04-01").collect()
    assert {r.will_purchase_future for r in f} <= {0, 1}
    assert all(r.total_orders > 0 for r in f)


def test_rfm_segments_and_scores(spark, tables):
    r = RFM.create_rfm_features(tables["orders"])
    assert {x.segment for x in r.collect()} <= set(SEGMENTS)
    assert {"R_score", "F_score", "M_score", "RFM_score"} <= set(r.columns)


def test_all_users_survive_joins(spark, tables):
    fm = FE.engineer_features(tables)
    assert fm.count() == 3
    u2 = fm.where(F.col("user_id") == "U2").first()
    assert u2.total_orders == 0 and u2.total_spend == 0
    assert "is_new_user" in fm.columns and "is_veteran_user" in fm.columns


def test_temporal_features_know_nothing_of_the_future(spark):
    users = spark.sql("select 1L user_id, 30 age, 'mobile' device_type, 'gold' membership, date'2020-01-01' signup_date")
    products = spark.sql("select 5L product_id, 'c' category")
    orders = spark.sql("""select * from values (1L, 1L, timestamp'2021-01-05', 10.0D, 0), (2L, 1L, timestamp'2021-03-01', 99.0D, 0),
                          (3L, 2L, timestamp'2021-03-30', 1.0D, 0) t(order_id, user_id, order_date, total_amount, discount_pct)""")
    sessions = spark.sql("""select * from values (1L, 1L, timestamp'2021-01-01', 60.0D, 3, false), (2L, 1L, timestamp'2021-03-10', 900.0D, 50, true)
                            t(session_id, user_id, session_start, duration_secs, pages_visited, bounced)""")

    def matrix(second_event):
        events = spark.sql(f"""select * from values (1L, 1L, 5L, timestamp'2021-01-01', 1, 0), (2L, 1L, 5L, timestamp'{second_event}', 1, 1)
                               t(event_id, user_id, product_id, event_ts, added_to_cart, wishlisted)""")
        return FE.create_temporal_features(users, sessions, events, orders, products)

    late = matrix("2021-03-02").collect()
    assert late == matrix("2021-03-29").collect() != matrix("2021-02-01").collect()
    r = late[0]
    assert (r.total_sessions, r.total_events, r.past_total_orders, r.past_total_spend) == (1, 1, 1, 10.0)
    assert r.will_purchase_next_30days == 1 and r.max_duration == 60.0


def test_temporal_features_of_the_driver_tables_see_both_sides(spark):
    from shoplens.plans.catalog import REGISTRY

    df = REGISTRY["temporal_features"](spark, "/root/testdata/sf0.001")
    s = df.agg(F.sum("total_sessions").alias("s"), F.sum("total_events").alias("e")).first()
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    assert s.s > 0 and 0 < s.e < events


def test_listing_reads_only_what_it_needs(spark):
    from shoplens.plans.catalog import REGISTRY

    plan = REGISTRY["customer_listing"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "p_type" not in plan and "ExistingRDD" not in plan
