"""Readers and writers: CSV / Parquet fallback, required tables, JDBC
(embedded in-memory Derby: no server, no port), report sinks."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from shoplens.sources import files, jdbc, sinks


def test_csv_required_and_fallback(spark, tmp_dir):
    orders = spark.createDataFrame(
        [("O1", "U1", dt.datetime(2024, 1, 1), 10.0, "delivered", "upi", 5)],
        "order_id string, user_id string, order_date timestamp, total_amount double, status string, "
        "payment_method string, discount_pct int",
    )
    orders.write.option("header", True).csv(os.path.join(tmp_dir, "orders.csv"))
    with pytest.raises(FileNotFoundError, match="users"):
        files.load_tables(spark, tmp_dir, ["orders", "users"])
    got = files.load_tables(spark, tmp_dir, ["orders", "users"], required=False)
    assert set(got) == {"orders"} and got["orders"].first().total_amount == 10.0
    assert (got["orders"].first().order_id, got["orders"].first().user_id) == ("O1", "U1")
    assert files.load_table(spark, tmp_dir, "orders").count() == 1
    orders.write.parquet(os.path.join(tmp_dir, "orders.parquet"))
    assert files.load_table(spark, tmp_dir, "orders").count() == 1
    assert files.load_table(spark, tmp_dir, "nothing") is None


def test_jdbc_window_and_params(spark):
    url = "jdbc:derby:memory:shoplens_test;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    orders = spark.createDataFrame(
        [(f"O{i}", f"U{i % 3}", dt.datetime(2024, 1, 1 + i), 10.0 * i, "delivered", "upi", 0) for i in range(10)],
        "order_id string, user_id string, order_date timestamp, total_amount double, status string, "
        "payment_method string, discount_pct int",
    )
    orders.write.format("jdbc").option("url", url).option("dbtable", "orders").options(**props).mode("overwrite").save()
    w = jdbc.fetch_window(spark, url, "orders", "2024-01-03", "2024-01-05", props)
    assert w.count() == 3  # inclusive ends, bare end date = its midnight
    q = jdbc.execute_query(spark, url, ["orders"], "SELECT count(*) AS n FROM orders WHERE total_amount > :amt",
                           {"amt": 45.0}, props)
    assert q.first().n == 5
    ok, failed = jdbc.fetch_all(spark, url, "2024-01-01", "2024-01-31", props, ["orders", "missing_table"])
    assert set(ok) == {"orders"} and set(failed) == {"missing_table"}


def test_report_sinks(spark, tmp_dir):
    from shoplens.operators import metrics as ME

    sc = spark.createDataFrame([(i, i % 2, i / 10.0, int(i >= 5)) for i in range(10)],
                               "id long, y_true int, y_score double, y_pred int")
    lift = ME.lift_table(sc, "id")
    imp = spark.createDataFrame([("a", 0.5), ("b", 0.2)], "feature string, importance double")
    sinks.write_evaluation_report(ME.binary_metrics(sc), lift, ME.roc_points(sc), imp, tmp_dir)
    doc = spark.read.json(os.path.join(tmp_dir, "dashboard_data")).first()
    assert len(doc.lift_summary) == 5 and doc.feature_importance.labels == ["a", "b"]
    rep = spark.read.option("header", True).csv(os.path.join(tmp_dir, "evaluation_report"))
    assert rep.count() == 4
    sinks.append_run_summary(spark, os.path.join(tmp_dir, "runs"), "r1", {"load": 1.0}, "lr", {"auc": 0.9})
    sinks.append_run_summary(spark, os.path.join(tmp_dir, "runs"), "r2", {"load": 1.0}, "lr", {"auc": 0.9})
    assert spark.read.parquet(os.path.join(tmp_dir, "runs")).count() == 2


def test_raw_folder_by_uri_and_loud_bad_rows(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "users.csv"), "w") as f:
        f.write("user_id,name,email,age,gender,city,state,device_type,membership,signup_date\n"
                "U00001,A,a@b.c,30,f,X,Y,mobile,gold,2020-01-31\n")
    spark.createDataFrame([("x", 1)], "a string, b int").write.option("header", True).csv(os.path.join(tmp_dir, "other.csv"))
    uri = "file://" + tmp_dir
    got = files.load_raw(spark, uri)
    assert list(got) == ["other", "users"]
    assert got["users"].first().user_id == "U00001" and got["users"].first().signup_date == dt.date(2020, 1, 31)
    assert files.load_tables(spark, uri, ["users", "orders"], required=False).keys() == {"users"}
    assert files.load_table(spark, uri, "users").count() == 1 and files.load_table(spark, uri, "orders") is None
    assert files.load_raw(spark, uri + "/none") == {}
    with open(os.path.join(tmp_dir, "products.csv"), "w") as f:
        f.write("product_id,product_name,category,subcategory,price,rating,review_count,stock_qty,is_featured\nP1,a,b,c,cheap,4.5,1,1,true\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        files.load_table(spark, uri, "products").collect()


def test_tables_matrix_and_appended_text_ids(spark, tmp_dir):
    from shoplens.operators.business import append_scored

    users = spark.createDataFrame([("U00007", 0.5), ("U00012", 0.1), ("guest", 0.2)], "user_id string, p double")
    sinks.write_tables({"users": users}, tmp_dir)
    assert spark.read.parquet(f"{tmp_dir}/users.parquet").count() == spark.read.option("header", True).csv(f"{tmp_dir}/users.csv").count() == 3
    assert sinks.write_feature_matrix(users, f"{tmp_dir}/fm") == f"{tmp_dir}/fm.parquet"
    new = spark.createDataFrame([(2, 0.9), (1, 0.8)], "arrival int, p double")
    out = append_scored(users.withColumn("arrival", F.lit(0)), new, order_col="arrival")
    assert {r.user_id: r.p for r in out.collect()} == {"U00007": 0.5, "U00012": 0.1, "guest": 0.2, "U00013": 0.8, "U00014": 0.9}


def test_csv_columns_by_name_and_rejects(spark, tmp_dir):
    path = os.path.join(tmp_dir, "order_items.csv")
    os.makedirs(path)
    header = "unit_price,order_id,note,order_item_id,quantity,product_id\n"
    with open(f"{path}/a.csv", "w") as f:
        f.write(header + "2.5,O1,x,I1,3,P1\ncheap,O2,x,I2,1,P2\n1.0,O3,x,I3,many,P3\n")
    with open(f"{path}/b.csv", "w") as f:
        f.write(header + ",O4,,I4,,P4\n1.0,O5,x,I5\n1.0,O6,x,I6,1,P6,more\n")
    good = files.read_csv(spark, path, "order_items", rejects=f"{tmp_dir}/rejects")
    assert [f.name for f in good.schema.fields] == ["order_item_id", "order_id", "product_id", "quantity", "unit_price"]
    assert sorted(map(tuple, good.collect())) == [("I1", "O1", "P1", 3, 2.5), ("I4", "O4", "P4", None, None)]
    bad = {r.row: (r.reason, r.file.rsplit("/", 1)[1]) for r in spark.read.parquet(f"{tmp_dir}/rejects").collect()}
    assert bad == {"cheap,O2,x,I2,1,P2": ("could not parse unit_price", "a.csv"), "1.0,O3,x,I3,many,P3": ("could not parse quantity", "a.csv"),
                   "1.0,O5,x,I5": ("malformed row", "b.csv"), "1.0,O6,x,I6,1,P6,more": ("malformed row", "b.csv")}
    with pytest.raises(Exception, match="could not parse|malformed"):
        files.read_csv(spark, path, "order_items").count()
    with open(f"{path}/c.csv", "w") as f:
        f.write("order_id,unit_price,note,order_item_id,quantity,product_id\nO7,1.0,x,I7,1,P7\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_csv(spark, path, "order_items", rejects=f"{tmp_dir}/more").collect()
    os.makedirs(os.path.join(tmp_dir, "short"))
    with open(f"{tmp_dir}/short/order_items.csv", "w") as f:
        f.write("order_id,product_id\n")
    with pytest.raises(ValueError, match="order_item_id"):
        files.load_tables(spark, f"{tmp_dir}/short", ["order_items"])
