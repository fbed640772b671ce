"""A stream that is stopped and resumed scores as one batch does, each row once."""

import os

from shoplens.ml import train as ML
from shoplens.ml.rates import RateEstimator
from shoplens.operators import splits as SP
from shoplens.streaming.scoring import replay_files, score_resumed

from tests.test_ml_stream import feature_frame


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_rate_model_resumed_equals_batch(spark, tmp_dir):
    fm = feature_frame(spark, 300)
    model = RateEstimator(["device_type"], "will_purchase").fit(fm).pinned()
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    replay_files(fm.repartition(6), src, rows_per_file=20)
    assert len([n for n in os.listdir(src) if n.endswith(".parquet")]) >= 15
    got = score_resumed(spark, model, [], fm.schema, src, out, ck, files_per_batch=4, stop_after=2)
    assert len([n for n in os.listdir(f"{ck}/commits") if n.isdigit()]) >= 4  # several batches
    assert same(ML.batch_score(model, fm, []), got)


def test_pipeline_resumed_equals_batch_and_empty_source(spark, tmp_dir):
    fm = feature_frame(spark, 90).drop("device_type")
    feats = ["x1", "x2"]
    model = ML.logistic_regression(feats, "will_purchase", 90, max_iter=10).fit(SP.with_weights(fm, "will_purchase"))
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in", "out", "ck"))
    replay_files(fm.repartition(5), src)
    assert same(ML.batch_score(model, fm, feats), score_resumed(spark, model, feats, fm.schema, src, out, ck, files_per_batch=2))
    src, out, ck = (os.path.join(tmp_dir, d) for d in ("in0", "out0", "ck0"))
    replay_files(fm.where("user_id < 0"), src)
    assert score_resumed(spark, model, feats, fm.schema, src, out, ck).count() == 0
