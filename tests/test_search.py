"""The search as a table: points by hash order, a row per point and fold, the winner its own maximum."""

import hashlib

import pytest
from pyspark.sql import functions as F
from shoplens.ml import search as S
from shoplens.ml import spaces
from shoplens.ml import train as ML
from shoplens.operators import splits as SP

from tests.test_ml_stream import feature_frame


def test_points_by_hash_order():
    space = {"a": [1, 2, 3], "b": ["x", "y"]}
    drawn = spaces.hash_draw(space, 4, 7)
    by_hash = sorted(range(6), key=lambda k: hashlib.md5(f"7|point|{k}".encode()).hexdigest())
    assert [k for k, _ in drawn] == by_hash[:4]
    assert all(p == {"a": [1, 2, 3][k % 3], "b": ["x", "y"][k // 3]} for k, p in drawn)
    assert len(spaces.hash_draw(space, 99)) == 6
    assert len({tuple(p.items()) for _, p in spaces.hash_draw(spaces.ADVANCED_SPACES["boosted_depth"], 20)}) == 20


def test_search_of_a_pipeline_and_its_winner(spark):
    fm = SP.with_weights(feature_frame(spark, 240).drop("device_type"), "will_purchase")
    feats = ["x1", "x2"]
    est = ML.logistic_regression(feats, "will_purchase", 240, max_iter=20)
    space = {"C": [1e-6, 1.0], "penalty": ["l1"]}
    model, point, table = S.search_best(fm, space, S.pipeline_fit(est, 240), "will_purchase", n_iter=2, folds=3)
    rows = table.collect()
    assert len(rows) == 6 and {r.place for r in rows} == {1, 2}
    assert point["C"] == 1.0  # the other leaves no coefficient
    best = [r for r in rows if r.place == 1]
    assert best[0].mean_auc == max(r.mean_auc for r in rows) == pytest.approx(sum(r.val_auc for r in best) / 3)
    assert sum(r.n_val for r in best) == 240 and all(r.n_train + r.n_val == 240 for r in rows)
    assert ML.score(model, fm, "will_purchase").count() == 240


def test_folds_without_a_class(spark):
    df = feature_frame(spark, 12).withColumn("will_purchase", (F.col("user_id") == 3).cast("int"))
    from shoplens.ml.rates import RateEstimator

    fit = lambda point, train: RateEstimator(["device_type"], "will_purchase", point["prior"]).fit(train)
    _, table = S.search_table(df, {"prior": [1.0, 2.0]}, fit, "will_purchase", n_iter=2, folds=2)
    rows = table.collect()
    assert len(rows) == 4 and sum(r.val_auc is not None for r in rows) == 2
    assert all(r.train_auc is None or r.val_auc is None for r in rows)
