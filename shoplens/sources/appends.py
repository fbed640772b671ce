"""Appends that may be repeated (S13): a job that is run again adds nothing.

Rows are staged first, under a folder of their own (``data/attempt=...``), numbered
1, 2, ... in their order.  One small file per run in ``log/`` then makes them part
of the table and reserves their ids, first_id ... last_id; that file is renamed into
place under the next free number, which fails if another writer was quicker.  A run
whose id is already in the log is left out, and staged rows without an entry are
never read, so a writer may die at any point and simply be started again.
The file system's rename must be atomic (HDFS, local); the log has one entry a run.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators.ranking import global_rank

ENTRY = "seq long, run_id string, attempt string, first_id long, n_rows long, last_id long, schema string"
RANK = "_append_rank"


@dataclass(frozen=True)
class Staged:
    """Rows written but not yet part of the table; ``own_last`` is the largest id
    that they bring along (null: they get new ids)."""

    attempt: str
    n_rows: int
    own_last: int | None
    schema: str


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def entries(spark: SparkSession, path: str) -> list[Row]:
    """The log in order, one row per run."""
    if not exists(spark, f"{path}/log"):
        return []
    return spark.read.schema(ENTRY).json(f"{path}/log").orderBy("seq").collect()


def id_number(df: DataFrame, id_col: str):
    """An id as a number: text ids by the digits they end in (without: null)."""
    if df.schema[id_col].dataType.typeName() == "string":
        return F.regexp_extract(id_col, r"(\d+)$", 1).try_cast("long")
    return F.col(id_col).cast("long")


def stage(df: DataFrame, path: str, id_col: str, order_col: str | None = None) -> Staged:
    """Writes ``df`` aside: with its own ids, or with ``order_col`` to be numbered in that
    order (by a distributed ranking) when published.  Null order values come last."""
    if RANK in df.columns or "attempt" in df.columns:
        raise ValueError(f"columns {RANK} and attempt are taken")
    spark, attempt = df.sparkSession, f"a{uuid.uuid4().hex}"
    if order_col is None:
        rows = df.withColumn(RANK, F.lit(None).cast("long"))
    else:
        ranked = global_rank(df, order_col, None, rank_col=RANK).withColumn(RANK, F.col(RANK).cast("long"))
        rows = ranked.withColumn(id_col, F.lit(None).cast(df.schema[id_col].dataType)).select(*df.columns, RANK)
    folder = f"{path}/data/attempt={attempt}"
    rows.write.parquet(folder)
    seen = spark.read.schema(rows.schema).parquet(folder).agg(F.count(F.lit(1)).alias("n"), F.max(id_number(df, id_col)).alias("last")).first()
    shape = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    return Staged(attempt, seen.n, None if order_col else (seen.last or 0), shape.json())


def publish(spark: SparkSession, path: str, run_id: str, staged: Staged) -> bool:
    """Makes staged rows part of the table; False if ``run_id`` is there already."""
    while True:
        log = entries(spark, path)
        if any(e.run_id == run_id for e in log):
            return False
        if log and log[0].schema != staged.schema:
            raise ValueError(f"columns differ from the table's: {staged.schema} against {log[0].schema}")
        last = max((e.last_id for e in log), default=0)
        if staged.own_last is None:
            first, last = last + 1, last + staged.n_rows
        else:
            first, last = None, max(last, staged.own_last)
        entry = {"seq": len(log), "run_id": run_id, "first_id": first, "last_id": last} | {
            k: v for k, v in asdict(staged).items() if k != "own_last"}
        if _create(spark, f"{path}/log", f"{len(log):012d}.json", json.dumps(entry)):
            return True


def _create(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Writes a file whole or not at all; False if there is one of that name."""
    fs = spark._jvm.org.apache.hadoop.fs
    target = fs.Path(folder, name)
    hidden = fs.Path(folder, f".{uuid.uuid4().hex}")  # readers skip names with a dot
    conf = spark._jsc.hadoopConfiguration()
    out = target.getFileSystem(conf).create(hidden, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    never = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        fs.FileContext.getFileContext(target.toUri(), conf).rename(hidden, target, never)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception.getClass().getName()):
            raise
        target.getFileSystem(conf).delete(hidden, False)
        return False
    return True


def append_once(df: DataFrame, path: str, run_id: str, id_col: str = "user_id", order_col: str | None = None) -> bool:
    """S13 sink: adds ``df`` under ``run_id`` once, however often it is called.

    With ``order_col`` the rows get the ids after the table's largest, in that order.
    """
    spark = df.sparkSession
    if any(e.run_id == run_id for e in entries(spark, path)):
        return False
    return publish(spark, path, run_id, stage(df, path, id_col, order_col))


def read_appended(spark: SparkSession, path: str, id_col: str = "user_id", id_format: str = "U%05d") -> DataFrame:
    """The table as of now: the rows of all published runs with their ids.

    Only the folders named in the log are read.
    """
    log = entries(spark, path)
    if not log:
        raise FileNotFoundError(f"nothing was published under {path}")
    shape = T.StructType.fromJson(json.loads(log[0].schema))
    rows = spark.read.schema(T.StructType([*shape.fields, T.StructField(RANK, T.LongType()), T.StructField("attempt", T.StringType())])) \
        .option("basePath", f"{path}/data").parquet(*[f"{path}/data/attempt={e.attempt}" for e in log])
    firsts = spark.createDataFrame([(e.attempt, e.first_id) for e in log], "_attempt string, _first long")
    number = F.col("_first") + F.col(RANK) - 1
    fresh = F.format_string(id_format, number) if shape[id_col].dataType.typeName() == "string" else number.cast(shape[id_col].dataType)
    ids = F.when(F.col(RANK).isNull(), F.col(id_col)).otherwise(fresh)
    return rows.join(firsts, F.col("attempt") == F.col("_attempt")).withColumn(id_col, ids).select(*shape.names)
