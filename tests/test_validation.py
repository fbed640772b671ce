"""Data-quality checks (ported exact-value cases)."""

import datetime as dt

from shoplens.operators import quality as Q


def levels(df):
    return [r.level for r in df.collect()]


def test_freshness_with_injected_reference(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-05",)], "d string")
    fresh = Q.check_data_freshness(df, "d", 7, dt.datetime(2024, 1, 10)).first()
    assert fresh.level == "ok" and fresh.value == 5
    stale = Q.check_data_freshness(df, "d", 7, dt.datetime(2024, 2, 1)).first()
    assert stale.level == "warning"


def test_freshness_absent_column_passes(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert levels(Q.check_data_freshness(df, "d")) == ["ok"]


def test_orphans_with_sample(spark):
    parent = spark.createDataFrame([("U1",), ("U2",)], "user_id string")
    child = spark.createDataFrame([("O1", "U1"), ("O2", "U999")], "order_id string, user_id string")
    row = Q.check_referential_integrity(child, parent, "user_id", "user_id", "orders", "users").first()
    assert row.level == "error" and row.value == 1 and "U999" in row.detail


def test_orphans_null_key_semantics(spark):
    child = spark.createDataFrame([(None,), ("a",)], "k string")
    assert Q.orphans(child, spark.createDataFrame([("a",)], "k string"), "k", "k").count() == 1
    assert Q.orphans(child, spark.createDataFrame([("a",), (None,)], "k string"), "k", "k").count() == 0


def test_missing_fk_column_warns(spark):
    parent = spark.createDataFrame([(1,)], "id int")
    child = spark.createDataFrame([(1,)], "other_col int")
    assert levels(Q.check_referential_integrity(child, parent, "id", "id")) == ["warning"]


def test_missing_value_threshold(spark):
    one_third = spark.createDataFrame([(1.0, 1.0), (None, 2.0), (3.0, 3.0)], "a double, b double")
    assert levels(Q.check_missing_values(one_third, 0.5)) == ["warning"]
    two_thirds = spark.createDataFrame([(1.0,), (None,), (None,)], "a double")
    assert levels(Q.check_missing_values(two_thirds, 0.5)) == ["error"]
    assert not Q.is_valid(Q.validate_all(two_thirds, "t"))


def test_duplicates(spark):
    dup = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    assert Q.check_duplicates(dup).first().value == 1
    assert Q.check_duplicates(spark.createDataFrame([(1,), (2,), (3,)], "a int")).first().level == "ok"


def test_schema_types_ranges(spark):
    df = spark.createDataFrame([(1, 2.5, "x")], "a bigint, b double, c string")
    assert levels(Q.validate_schema(df, ["a", "z"])) == ["error"]
    t = {r.column: r.level for r in Q.check_data_types(df, {"a": "int64", "b": "int", "c": "object"}).collect()}
    assert t == {"a": "ok", "b": "error", "c": "ok"}
    r = Q.check_value_ranges(spark.createDataFrame([(1,), (50,), (None,)], "a int"), {"a": (0, 10)}).first()
    assert r.value == 1


def test_quality_report_top_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("a", None), ("c", 4.0)], "s string, x double")
    rep = {(r.column, r.metric): (r.value, r.detail) for r in Q.generate_quality_report(df, "t").collect()}
    assert rep[("*", "total_rows")][0] == 4
    assert rep[("s", "top1")] == (2.0, "a")
    assert rep[("x", "null_count")][0] == 1
