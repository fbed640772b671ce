"""Reproducible splits and class weights.

Assignment is a pure function of the data and a seed: rows are ordered by
``md5(seed | id)`` inside each class, so the same split can be recomputed by
any engine (and by a later job) without storing it.  Positions come from the
distributed ``global_rank`` with the class as key and the hash as
tie-break, so even a class holding most rows is ranked by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators.ranking import global_rank

TIME_COLUMNS = ["days_since_last_session", "days_since_last_order", "account_age_days"]


def seeded_hash(id_col: str, seed: int) -> F.Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


def _require_classes(df: DataFrame, target: str) -> None:
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found")
    if df.select(target).distinct().limit(2).count() < 2:
        raise ValueError(f"target {target!r} needs at least two classes")


def rank_within_class(df: DataFrame, target: str, id_col: str, seed: int) -> DataFrame:
    """Adds ``class_rank`` (1-based position by hash inside the class) and
    ``class_n`` (class size)."""
    h = df.withColumn("_h", seeded_hash(id_col, seed)).withColumn(
        "_hn", F.conv(F.substring("_h", 1, 13), 16, 10).cast("double")
    )
    ranked = global_rank(h, target, "_hn", rank_col="_grank", extra_order=["_h", id_col])
    sizes = df.groupBy(target).agg(F.count(F.lit(1)).alias("class_n"))
    before = Window.orderBy(F.col(target).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("class_n").over(before), F.lit(0)))
    # one row per class (the window above and the broadcast); a null class is a class
    offsets = offsets.withColumnRenamed(target, "_class")
    return (
        ranked.join(F.broadcast(offsets), F.col(target).eqNullSafe(F.col("_class")))
        .withColumn("class_rank", F.col("_grank") - F.col("_off"))
        .drop("_h", "_hn", "_grank", "_off", "_class")
    )


def stratified_split(df: DataFrame, target: str, test_size: float = 0.2, seed: int = 42,
                     id_col: str = "user_id", validate: bool = True) -> DataFrame:
    """``split`` = 'test' for the first round(test_size * n_class) rows of
    each class in hash order, else 'train'.  Exact class proportions."""
    if validate:
        _require_classes(df, target)
    r = rank_within_class(df, target, id_col, seed)
    n_test = F.round(F.col("class_n") * F.lit(float(test_size)))
    return r.withColumn("split", F.when(F.col("class_rank") <= n_test, "test").otherwise("train")).drop(
        "class_rank", "class_n"
    )


def kfold_assign(df: DataFrame, target: str, k: int = 5, seed: int = 42, id_col: str = "user_id") -> DataFrame:
    """Stratified fold id 0..k-1 = (position in class - 1) mod k."""
    r = rank_within_class(df, target, id_col, seed)
    return r.withColumn("fold", ((F.col("class_rank") - 1) % k).cast("int")).drop("class_rank", "class_n")


def resolve_time_column(df: DataFrame, time_col: str | None = None) -> str:
    if time_col:
        return time_col
    for c in TIME_COLUMNS:
        if c in df.columns:
            return c
    raise ValueError("no time column found for a temporal split")


def temporal_split(df: DataFrame, target: str, time_col: str | None = None, ratio: float = 0.2,
                   id_col: str = "user_id", reverse: bool = False) -> DataFrame:
    """floor(n * ratio) rows go to 'test'.  Time columns are "days since",
    so by default the smallest values (newest activity) are the test set;
    ``reverse=True`` takes the largest instead."""
    col = resolve_time_column(df, time_col)
    n = df.agg(F.count(F.lit(1)).alias("_n"))
    ranked = global_rank(df, col, id_col, descending=reverse, rank_col="_pos")
    return (
        ranked.crossJoin(F.broadcast(n))
        .withColumn("split", F.when(F.col("_pos") <= F.floor(F.col("_n") * F.lit(float(ratio))), "test")
                    .otherwise("train"))
        .drop("_pos", "_n")
    )


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weight n / (k * n_class) per class and the positive
    weight neg / max(pos, 1)."""
    sizes = df.groupBy(target).agg(F.count(F.lit(1)).alias("count"))
    tot = sizes.agg(
        F.sum("count").alias("_n"),
        F.count(F.lit(1)).alias("_k"),
        F.sum(F.when(F.col(target) == 1, F.col("count")).otherwise(0)).alias("_pos"),
        F.sum(F.when(F.col(target) != 1, F.col("count")).otherwise(0)).alias("_neg"),
    )
    return sizes.crossJoin(F.broadcast(tot)).select(
        F.col(target),
        "count",
        (F.col("_n").cast("double") / (F.col("_k") * F.col("count")).cast("double")).alias("weight"),
        (F.col("_neg").cast("double") / F.greatest(F.col("_pos"), F.lit(1)).cast("double")).alias("pos_weight"),
    )


def with_weights(df: DataFrame, target: str, col: str = "weight") -> DataFrame:
    """Join the balanced class weight onto every row (for ``weightCol``)."""
    w = class_weights(df, target).select(target, F.col("weight").alias(col))
    return df.join(F.broadcast(w), target)
