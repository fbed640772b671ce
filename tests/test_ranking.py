"""global_rank / quantiles / qcut against brute force, incl. a hot key."""

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shoplens.operators import ranking as R


def test_global_rank_matches_sort_with_hot_key(spark):
    rnd = random.Random(7)
    rows = [(i, 5 if i % 3 else rnd.randint(0, 50), rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, k long, v double")
    got = R.global_rank(df, "k", "id", sums=["v"], buckets=16).toPandas().sort_values("rank")
    exp = pd.DataFrame(rows, columns=["id", "k", "v"]).sort_values(["k", "id"]).reset_index(drop=True)
    assert list(got["id"]) == list(exp["id"])
    assert list(got["rank"]) == list(range(1, 3001))
    assert np.allclose(got["cum_v"].values, exp["v"].cumsum().values)


def test_global_rank_descending_and_few_values(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(20)], "id long, s double")
    got = R.global_rank(df, "s", "id", descending=True).orderBy("rank").collect()
    exp = sorted(range(20), key=lambda i: (-(i % 3), i))
    assert [r.id for r in got] == exp


def test_exact_quantiles_match_pandas(spark):
    vals = [float(x) for x in np.random.default_rng(3).integers(0, 40, 501)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = R.quantile_values(df, "x", [0.0, 0.25, 0.5, 0.95, 1.0], buckets=8)
    exp = pd.Series(vals).quantile([0.0, 0.25, 0.5, 0.95, 1.0]).tolist()
    assert np.allclose(got, exp)


def test_quantile_even_count_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    assert R.quantile_values(df, "x", [0.5])[0] == 2.5


def test_qcut_differs_from_ntile(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 7)], "x double")
    q = R.exact_quantiles(df, "x", [0.25, 0.5, 0.75], ["a", "b", "c"])
    out = df.crossJoin(q).select("x", R.qcut_score(F.col("x"), [F.col("a"), F.col("b"), F.col("c")]).alias("s"))
    assert [r.s for r in out.orderBy("x").collect()] == [1, 1, 2, 3, 4, 4]


def test_keep_first_and_top_k(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 9, "z")], "k int, o int, v string")
    assert {r.k: r.v for r in R.keep_first(df, ["k"], ["o"]).collect()} == {1: "a", 2: "z"}
    top = R.top_k_per_group(df, ["k"], [F.desc("o")], 2).orderBy("k", "rank").collect()
    assert [(r.k, r.v) for r in top] == [(1, "c"), (1, "b"), (2, "z")]


def test_quantiles_and_rank_on_empty_input(spark):
    empty = spark.createDataFrame([], "id long, x double")
    assert R.quantile_values(empty, "x", [0.5, 0.95]) == [None, None]
    assert R.global_rank(empty, "x", "id").count() == 0


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_rank_plan_has_no_single_partition_exchange(spark):
    df = spark.range(2000).select((F.col("id") % 7).alias("k"), F.col("id"))
    plan = _physical(R.global_rank(df, "k", "id"))
    assert "SinglePartition" not in plan and "Window" not in plan


def test_keep_first_combines_before_its_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id"))
    plan = _physical(R.keep_first(df, ["k"], ["id"]))
    assert "Window" not in plan and "partial_min" in plan


def test_quantiles_of_several_columns(spark):
    vals = [float(x) for x in np.random.default_rng(9).normal(50, 20, 777).round(2)]
    df = spark.createDataFrame([(v, v * 2) for v in vals], "x double, y double")
    got = R.quantile_values_multi(df, {"x": [0.1, 0.5, 0.95], "y": [0.25]}, buckets=8)
    assert np.allclose(got["x"], pd.Series(vals).quantile([0.1, 0.5, 0.95]).tolist())
    assert np.allclose(got["y"], [pd.Series(vals).mul(2).quantile(0.25)])


def _ranks(spark, values, kind, **kw):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"k {kind}, id long")
    return [r.id for r in R.global_rank(df, "k", "id", buckets=6, **kw).orderBy("rank").collect()]


def test_global_rank_in_the_keys_own_type(spark):
    from decimal import Decimal

    rnd = random.Random(1)
    longs = [2**53 + rnd.randrange(40) for _ in range(300)]
    decimals = [Decimal(10**20 + rnd.randrange(50)) for _ in range(300)]
    texts = [f"customer-000000{rnd.randrange(90):04d}" for _ in range(300)]
    for values, kind in ((longs, "long"), (decimals, "decimal(30,0)"), (texts, "string")):
        assert _ranks(spark, values, kind) == sorted(range(300), key=lambda i: (values[i], i))
        assert _ranks(spark, values, kind, descending=True) == [
            i for v in sorted(set(values), reverse=True) for i in range(300) if values[i] == v]


def test_global_rank_null_and_nan_keys_come_last(spark):
    values = [2.0, None, float("nan"), 1.0, None, 3.0]
    assert _ranks(spark, values, "double") == [3, 0, 5, 2, 1, 4]
    assert _ranks(spark, values, "double", descending=True)[-2:] == [1, 4]


def test_hot_key_with_prefixed_ids_spreads(spark):
    df = spark.range(20000).select(F.lit(1.0).alias("s"), F.format_string("customer-%012d", "id").alias("cid"))
    placed = R._placed(df, [F.col("s").asc(), F.col("cid").asc()], 64)
    assert max(r["count"] for r in placed.groupBy("_part").count().collect()) < 20000 * 0.05


def test_quantiles_skip_nan_and_survive_a_hot_value(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "x double")
    assert R.quantile_values(df, "x", [0.5]) == [1.5]
    vals = [7.0] * 990 + [float(i) for i in range(10)]
    hot = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.0, 0.003, 0.009, 0.5, 0.9995, 1.0]
    assert np.allclose(R.quantile_values(hot, "x", probs), pd.Series(vals).quantile(probs).tolist())
    counted = hot.groupBy("x").count()
    assert counted.agg(F.max("count")).first()[0] == 991


def test_splits_and_metrics_with_nulls(spark):
    from shoplens.operators import metrics as E
    from shoplens.operators import splits as S

    rows = [(i, ["abcdefghi_a", "abcdefghi_x", None][i % 3], float(i) if i % 5 else None) for i in range(90)]
    df = spark.createDataFrame(rows, "user_id long, c string, t double")
    folds = S.kfold_assign(df, "c", 4).groupBy("c", "fold").count().collect()
    assert {r.fold for r in folds} == {0, 1, 2, 3} and all(r["count"] in (7, 8) for r in folds)
    assert S.stratified_split(df, "c", 0.2).groupBy("c", "split").count().where("split = 'test'").agg(F.sum("count")).first()[0] == 18
    assert S.temporal_split(df, "c", "t").where("split = 'test'").count() == 18
    scored = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, None), (None, 0.5), (0, float("nan"))], "y_true int, y_score double")
    assert E.roc_auc(scored).first()[0] == 1.0 and E.average_precision(scored).first()[0] == 1.0
    assert E.best_threshold(scored).first()["f1"] == 1.0
    assert E.lift_table(scored.withColumn("id", F.monotonically_increasing_id()), "id").count() == 2
