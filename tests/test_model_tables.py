"""Models as tables against the library's own scores, importances and optimum."""

import dataclasses
import os
import random
import re

import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import functions as F

from shoplens.ml import tables as T
from shoplens.ml import train as ML

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(500):
        a, b, c = rnd.random(), rnd.gauss(0, 3), float(rnd.randint(0, 4))
        rows.append((i, a, None if i % 41 == 0 else b, c, "uvwxyz"[i % 6], int(a + 0.1 * b + 0.2 * rnd.random() > 0.6), 1.0 + i % 3))
    return spark.createDataFrame(rows, "user_id long, a double, b double, c double, s string, y int, weight double").persist()


@pytest.fixture(scope="module")
def models(frame):
    return {"forest": ML.random_forest(FEATURES, "y", num_trees=12, max_depth=6).fit(frame.dropna()),
            "boosted": ML.gradient_boosting(FEATURES, "y", max_iter=15, step=0.1, max_depth=3).fit(frame.dropna())}


def by_id(df, value="y_score"):
    return {r["user_id"]: r[value] for r in df.collect()}


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_scores_and_importances_equal_the_library(spark, frame, models, kind, tmp_dir):
    model = models[kind]
    trees = T.tree_table(model, FEATURES)
    assert trees.kind == kind and trees.n_trees == model.stages[-1].getNumTrees
    T_path = os.path.join(tmp_dir, "trees")
    trees.write(T_path)
    trees = T.read_trees(spark, T_path)
    want = by_id(ML.score(model, frame, "y"))
    got = by_id(T.tree_scores(frame, trees))
    assert got.keys() == want.keys() and len(got) == 500
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)
    imp = {r.feature: r.importance for r in T.tree_importances(trees).collect()}
    lib = {r.feature: r.importance for r in ML.importances(model, FEATURES).collect()}
    assert imp.keys() == lib.keys() and all(abs(imp[f] - lib[f]) < 1e-12 for f in lib)
    assert sum(imp.values()) == pytest.approx(1.0)


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_another_engine_walks_the_same_table(frame, models, kind):
    trees = T.tree_table(models[kind], FEATURES)
    con = duckdb.connect()
    con.register("nodes", trees.nodes.toPandas())
    rows = frame.select("user_id", *FEATURES).fillna(float("inf")).toPandas()  # missing values go right
    con.register("people", rows)
    last = "avg(value)" if kind == "forest" else "1 / (1 + exp(-2 * sum(weight * value)))"
    got = dict(con.execute(f"""
        WITH RECURSIVE walk AS (
          SELECT user_id, a, b, c, tree, 0 AS node FROM people, (SELECT DISTINCT tree FROM nodes) t
          UNION ALL
          SELECT w.user_id, w.a, w.b, w.c, w.tree, CASE WHEN [w.a, w.b, w.c][n.feature + 1] <= n.threshold THEN n.left ELSE n.right END
          FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node WHERE n.feature >= 0)
        SELECT user_id, {last} FROM walk w JOIN nodes n ON n.tree = w.tree AND n.node = w.node AND n.feature < 0 GROUP BY 1
    """).fetchall())
    spark_side = by_id(T.tree_scores(frame, trees))
    assert got.keys() == spark_side.keys() and all(abs(got[k] - spark_side[k]) < 1e-9 for k in got)


def test_categories_go_by_membership(frame):
    stages = [StringIndexer(inputCol="s", outputCol="s_i"), VectorAssembler(inputCols=["a", "s_i"], outputCol="features"),
              RandomForestClassifier(featuresCol="features", labelCol="y", numTrees=8, maxDepth=6, seed=3)]
    noisy = frame.withColumn("y", (F.col("s").isin("u", "x") != (F.col("a") > 0.8)).cast("int"))
    model = Pipeline(stages=stages).fit(noisy)
    trees = T.tree_table(model, ["a", "s_i"])
    assert trees.nodes.where("categories IS NOT NULL").count() > 0
    want = by_id(ML.score(model, noisy, "y"))
    got = by_id(T.tree_scores(model.stages[0].transform(noisy), trees))
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_repeated_ids_empty_tables_and_bare_roots(spark, frame, models):
    trees = T.tree_table(models["boosted"], FEATURES)
    twice = frame.unionByName(frame.where("user_id < 10")).withColumn("value", F.lit("x")).withColumn("_x", F.lit(1))
    got, once = by_id(T.tree_scores(twice, trees)), by_id(T.tree_scores(frame, trees))
    assert all(abs(got[k] - once[k]) < 1e-12 for k in once)
    assert T.tree_scores(frame.limit(0), trees).count() == 0
    # One class alone: no tree splits, all importances are zero.
    plain = ML.random_forest(FEATURES, "y", num_trees=3, max_depth=2).fit(
        frame.withColumn("y", F.lit(1)).unionByName(frame.limit(1).withColumns({f: F.lit(0.0) for f in FEATURES} | {"y": F.lit(0)}))
        .withColumns({f: F.lit(2.0) for f in FEATURES}))
    bare = T.tree_table(plain, FEATURES)
    assert bare.n_nodes == 3 and [r.importance for r in T.tree_importances(bare).collect()] == [0.0] * 3
    with pytest.raises(ValueError):
        T.tree_table(ML.logistic_regression(FEATURES, "y", 500).fit(frame.fillna(0.0)), FEATURES)


def test_nothing_but_partial_sums_is_shuffled(frame, models):
    trees = T.tree_table(models["boosted"], FEATURES)
    plan = T.tree_scores(frame, trees)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


@pytest.mark.parametrize("penalty", ["l2", "l1", "elasticnet"])
def test_gradient_is_zero_at_the_optimum(frame, penalty):
    full = frame.fillna(0.0)
    est = ML.logistic_regression(FEATURES, "y", 500, C=0.05, penalty=penalty, max_iter=500)
    est.getStages()[-1].setTol(1e-12)
    rows = T.logistic_gradient(est.fit(full), full, FEATURES, "y").collect()
    assert [r.feature for r in rows] == [*FEATURES, "(intercept)"]
    assert max(abs(r.gradient) for r in rows) < 1e-5
    # A fit that is stopped early shows it.
    est.getStages()[-1].setMaxIter(1)
    early = T.logistic_gradient(est.fit(full), full, FEATURES, "y").collect()
    assert max(abs(r.gradient) for r in early) > 1e-3
    assert isinstance(est.getStages()[-1], LogisticRegression)


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_a_walk_at_preset_depth_is_compiled_and_on_all_cores(spark, frame, models, kind, capsys):
    """The JVM compiles no method of 8,000 bytes or more; it would interpret the walk."""
    trees = T.tree_table(models[kind], FEATURES)
    deep = dataclasses.replace(trees, depth=10, features=tuple(FEATURES * 13))
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        scores = T.tree_scores(frame.coalesce(1), deep)
        scores.explain("codegen")
        sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        plan = scores._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sizes and max(sizes) < 8_000
    assert f"RoundRobinPartitioning({max(spark.sparkContext.defaultParallelism, 4)})" in plan


def test_tables_too_large_to_send_give_the_same_scores(frame, models, monkeypatch):
    trees = T.tree_table(models["forest"], FEATURES)
    want = by_id(T.tree_scores(frame, trees))
    monkeypatch.setattr(T, "BROADCAST_NODES", 0)
    got = by_id(T.tree_scores(frame, trees))
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
