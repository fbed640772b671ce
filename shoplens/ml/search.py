"""M6, M7, M10 as a table: every drawn grid point on every fold, with train and validation scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.ml.spaces import hash_draw, param_map
from shoplens.ml.train import scored_table
from shoplens.operators import metrics as ME
from shoplens.operators.splits import kfold_assign

#: Digits of a mean AUC by which points are placed: sums of doubles differ beyond them.
PLACES = 9


def pipeline_fit(est: Pipeline, n_rows: int) -> Callable:
    """A Spark pipeline as ``fit(point, train)`` of ``search_table``."""
    return lambda point, train: est.fit(train, param_map(est.getStages()[-1], point, n_rows))


def search_table(df: DataFrame, space: dict[str, list], fit: Callable, label: str, n_iter: int = 30, folds: int = 5,
                 seed: int = 42, id_col: str = "user_id") -> tuple[dict[int, dict], DataFrame]:
    """The drawn points by number, and one row per point and fold.

    ``fit(point, train)`` gives a model.  Columns: point, fold, n_train, n_val,
    train_auc, val_auc, mean_auc and std_auc (of val_auc over the point's folds) and
    place (1: largest mean, ties to the smaller point).  An AUC is null where a side
    lacks a class; such folds take no part in the mean, points without any come last.
    """
    points = dict(hash_draw(space, n_iter, seed))
    data = kfold_assign(df, label, folds, seed, id_col).persist()

    def part(k: int, f: int) -> tuple:
        train = data.where(F.col("fold") != f).drop("fold")
        sides = [({"point": k, "fold": f, "side": "train"}, train),
                 ({"point": k, "fold": f, "side": "val"}, data.where(F.col("fold") == f).drop("fold"))]
        return (lambda: fit(points[k], train)), sides

    try:
        _, scored = scored_table({(k, f): part(k, f) for k in points for f in range(folds)}, label, id_col)
    finally:
        data.unpersist()
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    keys = ["point", "fold", "side"]
    # at most n_iter * folds * 2 rows from here on
    sizes = scored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows = ME.grouped_metrics(scored, keys).select(*keys, "auc_roc").join(sizes, keys).groupBy("point", "fold").agg(
        of("train", "n").alias("n_train"), of("val", "n").alias("n_val"),
        of("train", "auc_roc").alias("train_auc"), of("val", "auc_roc").alias("val_auc"))
    means = rows.groupBy("point").agg(F.avg("val_auc").alias("mean_auc"), F.stddev_pop("val_auc").alias("std_auc"))
    order = Window.orderBy(F.round("mean_auc", PLACES).desc_nulls_last(), "point")
    return points, rows.join(means.withColumn("place", F.row_number().over(order).cast("long")), "point")


def best_point(table: DataFrame) -> int:
    """The number of the point in first place."""
    return table.where(F.col("place") == 1).select("point").limit(1).collect()[0]["point"]


def search_best(df: DataFrame, space: dict[str, list], fit: Callable, label: str, n_iter: int = 30, folds: int = 5,
                seed: int = 42, id_col: str = "user_id") -> tuple:
    """(model of the best point over all of ``df``, that point, the search table)."""
    points, table = search_table(df, space, fit, label, n_iter, folds, seed, id_col)
    point = points[best_point(table)]
    return fit(point, df), point, table
