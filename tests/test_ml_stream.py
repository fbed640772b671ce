"""Spark ML pipeline, persistence, splits and the streaming scorer."""

import os
import random

from pyspark.sql import functions as F

from shoplens.ml import train as ML
from shoplens.operators import splits as SP
from shoplens.streaming.scoring import start_scoring


def feature_frame(spark, n=400):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        x1, x2 = rnd.random(), rnd.random()
        rows.append((i, x1, x2, float(rnd.randint(0, 200)), float(rnd.randint(0, 5)),
                     ["mobile", "tablet", "desktop"][i % 3], int(x1 + 0.3 * rnd.random() > 0.7)))
    return spark.createDataFrame(rows, "user_id long, x1 double, x2 double, days_since_last_order double, "
                                       "total_orders double, device_type string, will_purchase int")


def test_split_exact_proportions(spark):
    fm = feature_frame(spark)
    s = SP.stratified_split(fm, "will_purchase", 0.2, 42)
    counts = {(r.will_purchase, r.split): r["count"] for r in s.groupBy("will_purchase", "split").count().collect()}
    n1 = fm.where("will_purchase = 1").count()
    assert counts[(1, "test")] == round(n1 * 0.2)
    again = SP.stratified_split(fm, "will_purchase", 0.2, 42)
    assert s.where("split = 'test'").select("user_id").subtract(again.where("split = 'test'").select("user_id")).count() == 0


def test_train_score_save_load_and_stream(spark, tmp_dir):
    fm = feature_frame(spark)
    train, test = ML.prepare(fm, "will_purchase")
    feats = ML.feature_columns(train)
    assert "device_type" in feats  # label-encoded to a number
    ests = {"lr": ML.logistic_regression(feats, "will_purchase", train.count()),
            "gbt": ML.gradient_boosting(feats, "will_purchase", max_iter=5, step=0.1, max_depth=3)}
    models, results = ML.train_all(train, test, ests, "will_purchase")
    board = ML.leaderboard(results).collect()
    assert len(board) == 2 and board[0].auc_roc >= board[1].auc_roc
    rep = ML.overfit_report(results)
    assert ML.choose_model(rep) in ("lr", "gbt")
    assert ML.importances(models["gbt"], feats).count() == len(feats)
    assert ML.linear_attributions(models["lr"], train, feats).count() == len(feats)

    root = os.path.join(tmp_dir, "models")
    ML.save_model(models["lr"], os.path.join(root, "m1"), {"model": "lr", "feature_names": feats,
                                                            "trained_at": "2024-01-01T00:00:00"})
    ML.save_model(models["gbt"], os.path.join(root, "m2"), {"model": "gbt", "feature_names": feats,
                                                             "trained_at": "2024-06-01T00:00:00"})
    model, meta = ML.load_latest(spark, root)
    assert meta["model"] == "gbt"

    src = os.path.join(tmp_dir, "incoming")
    test.select("user_id", *feats).write.parquet(src)
    schema = spark.read.parquet(src).schema
    q = start_scoring(spark, model, feats, schema, src, os.path.join(tmp_dir, "scored"), os.path.join(tmp_dir, "ck"))
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(tmp_dir, "scored"))
    assert out.count() == test.count()
    assert out.where(F.col("adjusted_probability") > F.col("probability")).count() == 0


def test_advanced_training_and_bundle(spark):
    fm = feature_frame(spark, 300)
    train, test = ML.prepare(fm, "will_purchase")
    feats = ML.feature_columns(train)
    models, results, report, chosen = ML.train_all_advanced(
        train, test, feats, "will_purchase", n_iter=1, folds=2, trees=10, iterations=3, names=["logistic_l1_l2", "logistic_elasticnet"])
    assert len(models) == 6 and sum("(adv)" in m for m in models) == 1
    assert chosen in models and report.select("model").distinct().count() == len(models)
    lr = ML.logistic_regression(feats, "will_purchase", train.count())
    best, rows = ML.tune_best("logistic_regression", lr, {"C": [0.1, 1.0], "penalty": ["l1", "l2"]},
                              train, test, "will_purchase", n_iter=2, folds=2)
    assert rows.select("model").first().model == "logistic_regression (tuned)"
    fmx = ML.encode_strings(train, [fm], ["device_type"])[1][0].withColumn("total_spend", F.col("x1") * 100) \
        .withColumn("avg_order_value", F.col("x2") * 10)
    b = ML.live_metrics(models["logistic_regression"], fmx, feats).first()
    assert 0 <= b.metrics.auc_roc <= 1 and b.customer_stats.total_customers == 300


def test_cross_validation_and_learning_curve(spark):
    fm = feature_frame(spark, 200).drop("device_type")
    w = SP.with_weights(fm, "will_purchase")
    feats = ["x1", "x2", "days_since_last_order", "total_orders"]
    lr = {"lr": ML.logistic_regression(feats, "will_purchase", 200)}
    cv = ML.cross_validate_all(w, lr, "will_purchase", k=2).first()
    assert 0 <= cv.auc_mean <= 1 and cv.auc_std >= 0
    lc = ML.learning_curve(w, lr["lr"], "will_purchase", sizes=(0.5, 1.0), k=2).collect()
    assert [r["size"] for r in lc] == [0.5, 1.0]


def test_stream_restart_does_not_rescore(spark, tmp_dir):
    fm = feature_frame(spark, 120).drop("device_type")
    w = SP.with_weights(fm, "will_purchase")
    feats = ["x1", "x2", "days_since_last_order", "total_orders"]
    model = ML.logistic_regression(feats, "will_purchase", 120, max_iter=10).fit(w)
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    fm.select("user_id", *feats).where("user_id < 60").write.parquet(os.path.join(src, "part1"))
    schema = spark.read.parquet(os.path.join(src, "part1")).schema
    start_scoring(spark, model, feats, schema, os.path.join(src, "*"), out, ck).awaitTermination(120)
    assert spark.read.parquet(out).count() == 60
    # same input again, then one new file: only the new rows are scored
    start_scoring(spark, model, feats, schema, os.path.join(src, "*"), out, ck).awaitTermination(120)
    assert spark.read.parquet(out).count() == 60
    fm.select("user_id", *feats).where("user_id >= 60").write.parquet(os.path.join(src, "part2"))
    start_scoring(spark, model, feats, schema, os.path.join(src, "*"), out, ck).awaitTermination(120)
    assert spark.read.parquet(out).count() == 120


def test_search_spaces_are_valid_spark_parameters(spark):
    from shoplens.ml import spaces

    for name, est in ML.regularised_estimators(["x"], "y", 100).items():
        for point in spaces.draw(spaces.ADVANCED_SPACES[name], 40):
            assert est.getStages()[-1].copy(spaces.param_map(est.getStages()[-1], point, 100))
    base = ML.baseline_estimators(["x"], "y", 100)
    for name, space in spaces.SPACES.items():
        drawn = spaces.draw(space, 30)
        assert len({tuple(p.items()) for p in drawn}) == min(30, len(drawn)) and len(spaces.draw(space, 30, 1)) == len(drawn)
        assert all(spaces.param_map(base[name].getStages()[-1], p, 100) for p in drawn)


def test_registered_boosting_is_full_size(spark, monkeypatch):
    from pyspark.ml import Pipeline

    from shoplens.plans import catalog

    class Seen(Exception):
        pass

    fitted = []

    def fit(self, *args):
        last = self.getStages()[-1]
        if last.hasParam("stepSize"):
            fitted.append((last.getMaxIter(), last.getMaxDepth(), last.getStepSize()))
        raise Seen

    def train_all(train, test, ests, label):
        for est in ests.values():
            try:
                est.fit(train)
            except Seen:
                pass
        raise Seen

    fm = feature_frame(spark, 40)
    monkeypatch.setattr(catalog, "_ml_data", lambda *_: (ML, fm, fm, ["x1", "x2"]))
    monkeypatch.setattr(Pipeline, "fit", fit)
    monkeypatch.setattr(ML, "train_all", train_all)
    for query in (catalog.gbt_scores, catalog.importances, catalog.overfit_report):
        try:
            query(spark, "")
        except Seen:
            pass
    assert fitted == [(300, 5, 0.05), (300, 5, 0.05), (300, 5, 0.05), (300, 6, 0.05), (300, 6, 0.05)]
