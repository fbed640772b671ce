"""Sinks (S8-S13): tables, feature matrix, reports, run summaries, appends."""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators import metrics as ME
from shoplens.sources.appends import exists

RUNS = "run_id string, finished_at string, step_seconds string, best_model string, metrics string"


def write_table(df: DataFrame, path: str, csv: bool = True) -> None:
    """Parquet and (optionally) a CSV copy with header."""
    df.write.mode("overwrite").parquet(f"{path}.parquet")
    if csv:
        df.write.mode("overwrite").option("header", True).csv(f"{path}.csv")


def write_tables(tables: dict[str, DataFrame], out_dir: str, csv: bool = True) -> None:
    for name, df in tables.items():
        write_table(df, f"{out_dir}/{name}", csv)


def write_feature_matrix(fm: DataFrame, path: str) -> str:
    """Parquet; CSV for a matrix with a column that Parquet cannot hold.

    The choice is made from the schema, so a job that fails is never run again
    in another format.
    """
    if any(f.dataType.typeName() in ("void", "interval") for f in fm.schema.fields):
        fm.write.mode("overwrite").option("header", True).csv(f"{path}.csv")
        return f"{path}.csv"
    fm.write.mode("overwrite").parquet(f"{path}.parquet")
    return f"{path}.parquet"


def metrics_table(metrics_row: DataFrame) -> DataFrame:
    """(metric, value) rows rounded to 4 from a one-row metrics frame."""
    cols = metrics_row.columns
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return metrics_row.selectExpr(f"stack({len(cols)}, {pairs}) AS (metric, value)").withColumn(
        "value", F.round("value", 4))


def write_evaluation_report(metrics_row: DataFrame, lift: DataFrame, roc: DataFrame, importances: DataFrame,
                            out_dir: str, top: int = 10) -> None:
    """``evaluation_report`` CSV (metric, value) and one JSON document
    with metrics, the lift summary at 10-50 %, a thinned lift curve, ROC
    points and the top feature importances -- assembled as a single-row
    frame of structs and arrays (each part is bounded in size)."""
    metrics_table(metrics_row).coalesce(1).write.mode("overwrite").option("header", True).csv(
        f"{out_dir}/evaluation_report")
    n = lift.agg(F.count(F.lit(1)).alias("_n"))
    stride = F.greatest(F.floor(F.col("_n") / 100), F.lit(1))
    curve = lift.crossJoin(F.broadcast(n)).where((F.col("rank") - 1) % stride == 0).select(
        F.struct(F.round("pct_targeted", 4).alias("pct_targeted"), F.round("pct_captured", 4).alias("pct_captured"),
                 F.round("lift", 4).alias("lift")).alias("p"), "rank")
    summary = ME.lift_summary(lift).select(F.struct(
        "pct", F.round("pct_captured", 4).alias("pct_captured"), F.round("lift", 2).alias("lift")).alias("s"), "pct")
    doc = (
        metrics_row.select(F.struct(*[F.round(c, 4).alias(c) for c in metrics_row.columns]).alias("metrics"))
        .crossJoin(summary.agg(F.sort_array(F.collect_list(F.struct("pct", "s"))).alias("_ls"))
                   .select(F.col("_ls.s").alias("lift_summary")))
        .crossJoin(curve.agg(F.sort_array(F.collect_list(F.struct("rank", "p"))).alias("_lc"))
                   .select(F.col("_lc.p").alias("lift_curve")))
        .crossJoin(roc.agg(F.sort_array(F.collect_list(F.struct("point", F.array(F.round("fpr", 4), F.round("tpr", 4))
                                                                 .alias("xy")))).alias("_r"))
                   .select(F.col("_r.xy").alias("roc_curve")))
        .crossJoin(importances.orderBy(F.desc("importance"), "feature").limit(top)
                   .agg(F.collect_list("feature").alias("labels"),
                        F.collect_list(F.round("importance", 4)).alias("values"))
                   .select(F.struct("labels", "values").alias("feature_importance")))
    )
    doc.coalesce(1).write.mode("overwrite").json(f"{out_dir}/dashboard_data")


def append_run_summary(spark: SparkSession, path: str, run_id: str, step_seconds: dict[str, float],
                       best_model: str, metrics: dict[str, float]) -> None:
    """One row per pipeline run appended to a ``runs`` Parquet table.

    A run that is there already is left as it is, so the step may be repeated.
    """
    if exists(spark, path) and spark.read.schema(RUNS).parquet(path).where(F.col("run_id") == run_id).limit(1).count():
        return
    row = [(run_id, _dt.datetime.now(_dt.timezone.utc).isoformat(), json.dumps(step_seconds), best_model,
            json.dumps(metrics))]
    spark.createDataFrame(row, RUNS).write.mode("append").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """S13 sink: append newly scored rows to the stored table (``appends.append_once``
    for jobs that may be repeated)."""
    df.write.mode("append").parquet(path)
