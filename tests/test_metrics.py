"""Evaluation operators against hand-computed / brute-force goldens."""

import numpy as np
import pytest

from shoplens.operators import business as BZ
from shoplens.operators import metrics as ME


def scored(spark, ys, ss, thr=0.5):
    return spark.createDataFrame([(i, y, s, int(s >= thr)) for i, (y, s) in enumerate(zip(ys, ss))],
                                 "id long, y_true int, y_score double, y_pred int")


def brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y != 1]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_with_ties(spark):
    ys = [1, 0, 1, 0, 1, 0, 0, 1]
    ss = [0.9, 0.9, 0.5, 0.5, 0.3, 0.1, 0.7, 0.7]
    assert ME.roc_auc(scored(spark, ys, ss)).first().auc == pytest.approx(brute_auc(ys, ss))


def test_auc_single_class_is_null(spark):
    assert ME.roc_auc(scored(spark, [1, 1], [0.2, 0.4])).first().auc is None


def test_confusion_and_f1(spark):
    df = scored(spark, [1, 0, 1, 0], [0.9, 0.8, 0.2, 0.1])
    c = ME.confusion(df).first()
    assert (c.tn, c.fp, c.fn, c.tp) == (1, 1, 1, 1)
    m = ME.binary_metrics(df).first()
    assert m.accuracy == 0.5 and m.f1 == 0.5
    z = ME.binary_metrics(scored(spark, [0, 0], [0.1, 0.2])).first()
    assert z.precision == 0 and z.recall == 0 and z.f1 == 0


def test_average_precision_bruteforce(spark):
    rng = np.random.default_rng(5)
    ys = rng.integers(0, 2, 200).tolist()
    ss = np.round(rng.random(200), 2).tolist()
    order = sorted(set(ss), reverse=True)
    P = sum(ys)
    ap, tp, fp = 0.0, 0, 0
    for t in order:
        tp += sum(1 for y, s in zip(ys, ss) if s == t and y == 1)
        fp += sum(1 for y, s in zip(ys, ss) if s == t and y != 1)
        ap += sum(1 for y, s in zip(ys, ss) if s == t and y == 1) / P * tp / (tp + fp)
    assert ME.average_precision(scored(spark, ys, ss)).first().average_precision == pytest.approx(ap, abs=1e-9)


def test_best_threshold_tie_lowest(spark):
    df = scored(spark, [1, 0, 1], [0.8, 0.5, 0.3])
    b = ME.best_threshold(df).first()
    assert b.threshold == 0.3 and b.f1 == pytest.approx(0.8)


def test_lift_and_campaign(spark):
    ys = [1, 1, 0, 0, 1, 0, 0, 0, 0, 0]
    ss = [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.0]
    lift = ME.lift_table(scored(spark, ys, ss), "id")
    rows = {r["rank"]: r for r in lift.collect()}
    assert rows[2].pct_captured == pytest.approx(2 / 3) and rows[2].lift == pytest.approx((2 / 3) / 0.2)
    summ = {r.pct: r.pct_captured for r in ME.lift_summary(lift).collect()}
    assert summ[0.1] == pytest.approx(1 / 3) and summ[0.5] == pytest.approx(1.0)
    camp = {r.pct: r for r in BZ.campaign_table(lift).collect()}
    assert camp[1.0].targeted == 10 and camp[1.0].captured == 3
    assert camp[0.1].roi == pytest.approx((1 * 50 * 0.15 - 0.5) / 0.5 * 100)


def test_roc_points_start_and_end(spark):
    pts = ME.roc_points(scored(spark, [1, 0, 1, 0], [0.9, 0.8, 0.2, 0.1]), max_points=None).orderBy("point").collect()
    assert (pts[0].fpr, pts[0].tpr) == (0.0, 0.0) and (pts[-1].fpr, pts[-1].tpr) == (1.0, 1.0)


def test_decay_rules(spark):
    cases = [(60, 0), (61, 0), (90, 1), (91, 1), (119, 1), (120, 1), (149, 1), (150, 1), (179, 1), (180, 1)]
    df = spark.createDataFrame([(float(d), n, 1.0) for d, n in cases],
                               "days_since_last_order double, total_orders int, probability double")
    got = [r.adjusted_probability for r in BZ.apply_decay(df).collect()]
    assert got == [1.0, 0.3, 1.0, 0.7, 0.7, 0.5, 0.5, 0.35, 0.35, 0.25]
