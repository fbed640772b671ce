"""Appends that may be repeated: S13 by staged rows and a log, S12 by run id."""

import os
import threading

import pytest
from pyspark.sql import functions as F
from shoplens.sources import appends as AP
from shoplens.sources import sinks


def rows(spark, *values, ids="string"):
    return spark.createDataFrame([(None, v) for v in values], f"user_id {ids}, p double")


def test_a_repeated_run_adds_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    assert AP.append_once(spark.createDataFrame([("U00007", 0.5), ("guest", 0.2)], "user_id string, p double"), path, "base")
    assert AP.append_once(rows(spark, 0.9, 0.8), path, "r1", order_col="p")
    assert not AP.append_once(rows(spark, 0.9, 0.8), path, "r1", order_col="p")
    assert not AP.append_once(rows(spark, 0.1), path, "base")
    assert AP.append_once(rows(spark, 0.1), path, "r2", order_col="p")
    got = {r.user_id: r.p for r in AP.read_appended(spark, path).collect()}
    assert got == {"U00007": 0.5, "guest": 0.2, "U00008": 0.8, "U00009": 0.9, "U00010": 0.1}


def test_a_writer_that_dies_leaves_nothing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    with pytest.raises(FileNotFoundError):
        AP.read_appended(spark, path)
    AP.stage(rows(spark, 0.3, ids="long"), path, "user_id", "p")  # dies before it publishes
    assert AP.append_once(rows(spark, 0.3, ids="long"), path, "r", order_col="p")
    assert [tuple(r) for r in AP.read_appended(spark, path).collect()] == [(1, 0.3)]
    # two attempts of one run: the second to publish is left out
    a, b = (AP.stage(rows(spark, 0.4, ids="long"), path, "user_id", "p") for _ in range(2))
    assert AP.publish(spark, path, "twice", a) and not AP.publish(spark, path, "twice", b)
    assert sorted(r.user_id for r in AP.read_appended(spark, path).collect()) == [1, 2]


def test_writers_side_by_side_get_different_ids(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    staged = {f"r{i}": AP.stage(rows(spark, *[i + j / 10 for j in range(3)], ids="long"), path, "user_id", "p") for i in range(4)}
    threads = [threading.Thread(target=AP.publish, args=(spark, path, *x)) for x in staged.items()]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    got = AP.read_appended(spark, path).orderBy("user_id").collect()
    assert [r.user_id for r in got] == list(range(1, 13))
    for k in range(0, 12, 3):  # a run's ids are in one piece and in its order
        assert [int(r.p * 10 + 0.5) % 10 for r in got[k:k + 3]] == [0, 1, 2]


def test_taken_numbers_empty_runs_and_other_columns(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    assert AP._create(spark, path, "0.json", "{}") and not AP._create(spark, path, "0.json", "[]")
    assert open(f"{path}/0.json").read() == "{}" and len([n for n in os.listdir(path) if not n.startswith(".")]) == 1
    assert AP.append_once(rows(spark), path, "empty", order_col="p")
    assert AP.read_appended(spark, path).count() == 0
    assert AP.append_once(rows(spark, 2.0, None, 1.0), path, "nulls last", order_col="p")
    assert {r.user_id: r.p for r in AP.read_appended(spark, path).collect()} == {"U00001": 1.0, "U00002": 2.0, "U00003": None}
    with pytest.raises(ValueError, match="differ"):
        AP.append_once(rows(spark, 0.1).withColumn("more", F.lit(1)), path, "wide", order_col="p")
    with pytest.raises(ValueError, match="taken"):
        AP.append_once(rows(spark, 0.1).withColumn("attempt", F.lit(1)), path, "clash", order_col="p")


def test_run_summary_once(spark, tmp_dir):
    path = os.path.join(tmp_dir, "runs")
    for run in ("a", "b", "a"):
        sinks.append_run_summary(spark, path, run, {"load": 1.0}, "lr", {"auc": 0.9})
    assert sorted(r.run_id for r in spark.read.parquet(path).collect()) == ["a", "b"]
