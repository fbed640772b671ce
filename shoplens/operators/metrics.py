"""Evaluation operators over a scored frame.

Input columns: ``y_true`` (0/1), ``y_score`` (higher = more likely positive),
optionally ``y_pred``.  Curve-type metrics first collapse rows to distinct
scores (pos / neg counts per score), then take running sums in score order
with the distributed ``global_rank``.
Ratios of integer counts are formed last, so results are exactly
reproducible.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.operators.ranking import global_rank, with_next


def _div(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(scored: DataFrame, y: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """Tn, fp, fn, tp in one row."""
    t, p = F.col(y) == 1, F.col(pred) == 1
    return scored.agg(
        F.count_if(~t & ~p).alias("tn"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(t & p).alias("tp"),
    )


def binary_metrics(scored: DataFrame, y: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """Accuracy, precision, recall, F1 (zero division -> 0)."""
    c = confusion(scored, y, pred)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    return c.select(
        _div(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        _div(tp, tp + fp).alias("precision"),
        _div(tp, tp + fn).alias("recall"),
        _div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_report(scored: DataFrame, y: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """E5: per-class precision / recall / F1 / support, macro and weighted
    averages, and the accuracy row (F1 column, like a classification report)."""
    c = confusion(scored, y, pred)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    n = tp + fp + fn + tn
    per = c.select(
        _div(tn, tn + fn).alias("p0"), _div(tn, tn + fp).alias("r0"), _div(2 * tn, 2 * tn + fn + fp).alias("f0"),
        (tn + fp).alias("s0"),
        _div(tp, tp + fp).alias("p1"), _div(tp, tp + fn).alias("r1"), _div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        (tp + fn).alias("s1"),
        _div(tp + tn, n).alias("acc"), n.alias("n"),
    )
    rows = [
        ("'0'", "p0", "r0", "f0", "s0"),
        ("'1'", "p1", "r1", "f1", "s1"),
        ("'macro avg'", "(p0 + p1) / 2", "(r0 + r1) / 2", "(f0 + f1) / 2", "n"),
        ("'weighted avg'", "(p0 * s0 + p1 * s1) / n", "(r0 * s0 + r1 * s1) / n", "(f0 * s0 + f1 * s1) / n", "n"),
        ("'accuracy'", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "acc", "n"),
    ]
    stack = ", ".join(", ".join(r) for r in rows)
    return per.selectExpr(f"stack(5, {stack}) as (label, precision, recall, f1, support)")


def _usable(scored: DataFrame, y: str, score: str) -> DataFrame:
    s = F.col(score).cast("double")
    return scored.where(F.col(y).isNotNull() & s.isNotNull() & ~F.isnan(s))


def score_groups(scored: DataFrame, y: str = "y_true", score: str = "y_score") -> DataFrame:
    """Distinct scores with their positive and negative counts.  Rows without
    a label or a score (null or NaN) take no part in any curve metric."""
    return _usable(scored, y, score).groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")
    )


def _cumulative(scored: DataFrame, y: str, score: str, descending: bool) -> DataFrame:
    g = score_groups(scored, y, score)
    return global_rank(g, "score", None, descending=descending, sums=["pos", "neg"], rank_col="point")


def _totals(scored: DataFrame, y: str, score: str) -> DataFrame:
    return F.broadcast(_usable(scored, y, score).agg(F.count_if(F.col(y) == 1).alias("_P"), F.count_if(F.col(y) != 1).alias("_N")))


def roc_auc(scored: DataFrame, y: str = "y_true", score: str = "y_score") -> DataFrame:
    """ROC AUC with tied scores counted half (Mann-Whitney).  Null when a
    class is missing.  The numerator is a sum of half-integers: exact."""
    c = _cumulative(scored, y, score, descending=False)
    num = c.agg(F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") * 0.5)).alias("_u"))
    return num.crossJoin(_totals(scored, y, score)).select(
        F.try_divide(F.col("_u"), (F.col("_P") * F.col("_N")).cast("double")).alias("auc")
    )


def grouped_metrics(scored: DataFrame, groups: Sequence[str], y: str = "y_true", score: str = "y_score",
                    pred: str = "y_pred") -> DataFrame:
    """E2 and E3 of every group (model, split, fold, ...) at once: accuracy,
    precision, recall, f1, auc_roc.

    One aggregate for the counts and one grouped ranking for all curves, however
    many groups there are and however large one is.  A group without one of the
    classes has a null auc_roc.
    """
    t, p = F.col(y) == 1, F.col(pred) == 1
    s = F.col(score).cast("double")
    usable = F.col(y).isNotNull() & s.isNotNull() & ~F.isnan(s)
    c = scored.groupBy(*groups).agg(
        F.count_if(~t & ~p).alias("tn"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"), F.count_if(t & p).alias("tp"),
        F.count_if(usable & t).alias("_P"), F.count_if(usable & ~t).alias("_N"))
    g = scored.where(usable).groupBy(*groups, s.alias("score")).agg(
        F.count_if(t).alias("pos"), F.count_if(~t).alias("neg"))
    r = global_rank(g, "score", sums=["neg"], rank_col="_point", groups=groups)
    u = r.groupBy(*[F.col(x).alias(f"_{x}") for x in groups]).agg(
        F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") * 0.5)).alias("_u"))
    same = F.lit(True)
    for x in groups:
        same = same & F.col(x).eqNullSafe(F.col(f"_{x}"))
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    return c.join(u, same, "left").select(
        *groups,
        _div(tp + tn, tp + tn + fp + fn).alias("accuracy"), _div(tp, tp + fp).alias("precision"),
        _div(tp, tp + fn).alias("recall"), _div(2 * tp, 2 * tp + fp + fn).alias("f1"),
        F.try_divide(F.col("_u"), (F.col("_P") * F.col("_N")).cast("double")).alias("auc_roc"))


def average_precision(scored: DataFrame, y: str = "y_true", score: str = "y_score") -> DataFrame:
    """Sum over distinct thresholds of (recall step) x precision."""
    c = _cumulative(scored, y, score, descending=True)
    prec = F.col("cum_pos").cast("double") / (F.col("cum_pos") + F.col("cum_neg")).cast("double")
    s = c.agg(F.sum(F.col("pos") * prec).alias("_s"))
    return s.crossJoin(_totals(scored, y, score)).select(
        F.round(F.try_divide(F.col("_s"), F.col("_P").cast("double")), 9).alias("average_precision")
    )


def roc_points(scored: DataFrame, y: str = "y_true", score: str = "y_score", drop_intermediate: bool = True,
               max_points: int | None = 100) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score from high to low, after a
    (0, 0) start point; collinear interior points dropped like the usual
    ``drop_intermediate``; then thinned to every max(1, n // max_points)-th
    point.  A point is collinear with its neighbours when the step into it
    equals the step out of it, so only the next point's counts are looked at."""
    c = _cumulative(scored, y, score, descending=True)
    if drop_intermediate:
        c = with_next(c, ["pos", "neg"], "point")
        ends = (F.col("point") == 1) | F.col("next_pos").isNull()
        c = c.where(ends | (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg")))
        c = global_rank(c.drop("next_pos", "next_neg").withColumnRenamed("point", "_was"), "_was", None, rank_col="point")
    c = c.select(F.col("point").alias("pos_idx"), F.col("score").alias("threshold"),
                 F.col("cum_pos").alias("tps"), F.col("cum_neg").alias("fps"))
    start = scored.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("pos_idx"), F.lit(None).cast("double").alias("threshold"),
        F.lit(0).cast("long").alias("tps"), F.lit(0).cast("long").alias("fps"),
    )
    pts = start.unionByName(c).crossJoin(_totals(scored, y, score))
    pts = pts.select(
        F.col("pos_idx").alias("point"), "threshold",
        F.try_divide(F.col("fps").cast("double"), F.col("_N").cast("double")).alias("fpr"),
        F.try_divide(F.col("tps").cast("double"), F.col("_P").cast("double")).alias("tpr"),
    )
    if max_points:
        n = pts.agg(F.count(F.lit(1)).alias("_np"))
        stride = F.greatest(F.floor(F.col("_np") / F.lit(max_points)), F.lit(1))
        pts = pts.crossJoin(F.broadcast(n)).where(F.col("point") % stride == 0).drop("_np")
    return pts


def lift_table(scored: DataFrame, id_col: str, y: str = "y_true", score: str = "y_score") -> DataFrame:
    """Every row by score (desc, ties by id): pct_targeted, pct_captured,
    lift, plus ``rank`` and ``cum_buyers``."""
    scored = _usable(scored, y, score)
    r = global_rank(scored.select(id_col, y, score), score, id_col, descending=True, sums=[y])
    return r.crossJoin(F.broadcast(scored.agg(F.count(F.lit(1)).alias("_n"), F.sum(y).alias("_P")))).select(
        id_col,
        "rank",
        F.col(f"cum_{y}").alias("cum_buyers"),
        (F.col("rank").cast("double") / F.col("_n").cast("double")).alias("pct_targeted"),
        F.try_divide(F.col(f"cum_{y}").cast("double"), F.col("_P").cast("double")).alias("pct_captured"),
        F.try_divide(
            F.try_divide(F.col(f"cum_{y}").cast("double"), F.col("_P").cast("double")),
            F.col("rank").cast("double") / F.col("_n").cast("double"),
        ).alias("lift"),
        F.col("_n").alias("n_total"),
    )


def first_at_or_above(lift: DataFrame, pcts: Sequence[float], tolerance: float = 0.0) -> DataFrame:
    """For each depth p: the first lift row with pct_targeted >= p - tolerance.

    That row's rank is ceil((p - tol) * n) up to floating-point rounding, so
    each depth proposes three candidate ranks and an equi-join on ``rank``
    picks them; the exact condition (this row reaches the bound, the previous
    one does not) then keeps exactly one.  The depth table is a literal of
    ``3 * len(pcts)`` rows.
    """
    spark = lift.sparkSession
    n = lift.agg(F.max("n_total").alias("_n")).first()["_n"] or 0
    cands = []
    for p in pcts:
        r0 = int(math.ceil((float(p) - tolerance) * n))
        cands += [(float(p), r) for r in (r0 - 1, r0, r0 + 1) if 1 <= r <= n]
    depth = spark.createDataFrame(cands, "pct double, rank long")
    bound = F.col("pct") - F.lit(tolerance)
    prev = (F.col("rank") - 1).cast("double") / F.col("n_total").cast("double")
    return lift.join(F.broadcast(depth), "rank").where((F.col("pct_targeted") >= bound) & (prev < bound))


def lift_summary(lift: DataFrame, pcts: Sequence[float] = (0.1, 0.2, 0.3, 0.4, 0.5)) -> DataFrame:
    """Captured share and lift at the standard targeting depths."""
    return first_at_or_above(lift, pcts).select("pct", "pct_captured", "lift")


def best_threshold(scored: DataFrame, y: str = "y_true", score: str = "y_score") -> DataFrame:
    """The score threshold (predict score >= t) with the highest F1; ties
    go to the lowest threshold.  One pass over distinct scores."""
    c = _cumulative(scored, y, score, descending=True).crossJoin(_totals(scored, y, score))
    f1 = (2 * F.col("cum_pos")).cast("double") / (F.col("cum_pos") + F.col("cum_neg") + F.col("_P")).cast("double")
    best = c.select(F.struct(f1.alias("f1"), (-F.col("score")).alias("neg_t")).alias("_b")).agg(F.max("_b").alias("_b"))
    return best.select((-F.col("_b.neg_t")).alias("threshold"), F.col("_b.f1").alias("f1"))
