"""Cleaning operators: exact values on literal fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from shoplens.functions.dates import floor_days
from shoplens.functions.scalar import age_group
from shoplens.operators import clean as C


def test_median_fill(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "y"), (3.0, "z")], "a double, b string")
    out = C.handle_missing_values(df, "median").orderBy("b").collect()
    assert [r.a for r in out] == [1.0, 2.0, 3.0]


def test_mean_fill(spark):
    df = spark.createDataFrame([(1.0,), (None,), (5.0,)], "a double")
    assert sorted(r.a for r in C.handle_missing_values(df, "mean").collect()) == [1.0, 3.0, 5.0]


def test_mode_fill_ties_smallest(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "cat string")
    assert [r.cat for r in C.handle_missing_values(df).collect()].count("a") == 3
    tie = spark.createDataFrame([("b",), ("a",), (None,)], "cat string")
    assert sorted(r.cat for r in C.handle_missing_values(tie).collect()) == ["a", "a", "b"]


def test_remove_duplicates_full_row(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "a int, b string")
    assert C.remove_duplicates(df).count() == 2


def test_remove_duplicates_keep_first_by_order(spark):
    df = spark.createDataFrame([(1, "first", 0), (1, "second", 1), (2, "only", 0)], "id int, val string, seq int")
    out = {r.id: r.val for r in C.remove_duplicates(df, "id", ["seq"]).collect()}
    assert out == {1: "first", 2: "only"}


def test_clip_outliers_keeps_nulls_and_caps(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 11)] + [(None,)], "x double")
    out = [r.x for r in C.clip_outliers(df, "x", 0.9).collect()]
    # pandas: quantile(0.9) of 1..10 = 9.1
    assert max(v for v in out if v is not None) == 9.1
    assert out.count(None) == 1


def test_age_bins_edges(spark):
    df = spark.createDataFrame([(a,) for a in [17, 18, 25, 26, 35, 36, 50, 51, 70, 71, 72]], "age int")
    out = {r.age: r.g for r in df.select("age", age_group("age").alias("g")).collect()}
    assert out[17] is None and out[72] is None
    assert out[18] == "18-25" and out[25] == "18-25" and out[26] == "26-35"
    assert out[35] == "26-35" and out[36] == "36-50" and out[50] == "36-50"
    assert out[51] == "51+" and out[70] == "51+" and out[71] == "51+"


def test_floor_days_semantics(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 1), dt.datetime(2024, 1, 1, 23)), (dt.datetime(2024, 1, 1, 0), dt.datetime(2024, 1, 1, 1)),
         (dt.datetime(2024, 1, 3, 0), dt.datetime(2024, 1, 1, 0))],
        "a timestamp, b timestamp",
    )
    assert [r.d for r in df.select(floor_days("a", "b").alias("d")).collect()] == [0, -1, 2]


def test_will_purchase_target(spark):
    users = spark.createDataFrame(
        [(f"U{i}", 20 + i, "free" if i % 2 else "gold", dt.date(2023, 1, 1)) for i in range(10)],
        "user_id string, age int, membership string, signup_date date",
    )
    orders = spark.createDataFrame(
        [(f"O{i}", f"U{i % 5}", dt.datetime(2024, 1, 1 + i)) for i in range(8)],
        "order_id string, user_id string, order_date timestamp",
    )
    u = C.clean_users(users, orders)
    got = {r.user_id: r.will_purchase for r in u.collect()}
    assert sum(got.values()) == 5 and all(got[f"U{i}"] == 1 for i in range(5))
    row = u.where(F.col("user_id") == "U2").first()
    assert row.is_premium == 1 and row.membership_encoded == 2
    assert row.account_age_days == (dt.datetime(2024, 1, 8) - dt.datetime(2023, 1, 1)).days


def test_encode_ordinal_unknown_is_null(spark):
    df = spark.createDataFrame([("free",), ("gold",), ("diamond",)], "membership string")
    out = {r.membership: r.membership_encoded for r in C.encode_ordinal(df, "membership", ["free", "silver", "gold"]).collect()}
    assert out == {"free": 0, "gold": 2, "diamond": None}


def test_floor_days_matches_pandas_on_random_pairs(spark):
    import random

    import pandas as pd

    rnd = random.Random(21)
    base = dt.datetime(2020, 1, 1)
    pairs = [(base + dt.timedelta(seconds=rnd.randint(-10**8, 10**8)),
              base + dt.timedelta(seconds=rnd.randint(-10**8, 10**8))) for _ in range(500)]
    df = spark.createDataFrame(pairs, "a timestamp, b timestamp")
    got = [r.d for r in df.select(floor_days("a", "b").alias("d")).collect()]
    exp = [(pd.Timestamp(a) - pd.Timestamp(b)).days for a, b in pairs]
    assert got == exp
