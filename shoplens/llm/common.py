"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.session import checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path inside the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


#: Spark removes the shuffle files of a DataFrame's run as soon as it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here.

    A lost executor costs a re-read, never a recomputation of what lies before.
    With ``free`` the shuffle files of the writing go when it ends; otherwise they
    stay until the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true" if free else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def local_path(uri: str) -> str:
    """Plain path of a ``file:`` URI; other URIs come back unchanged."""
    if uri.startswith("file:"):
        return os.path.normpath("/" + uri[5:].lstrip("/"))
    return uri


#: What this Python worker keeps for the later tasks of one owner.
_KEPT: dict[object, object] = {}


def kept_by_worker(owner: object, make: Callable[[], object]) -> object:
    """``make()``, kept by this Python worker until another owner comes.

    Spark hands a worker from stage to stage, so what each of them kept would add up.
    """
    if owner not in _KEPT:
        let_go()
        _KEPT[owner] = make()
    return _KEPT[owner]


def let_go() -> None:
    """Drops what this worker keeps, if anything; operators without a cache start with it."""
    if _KEPT:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()


#: Rows that a worker turns into Python values at a time.
PIECE_ROWS = 256


def in_pieces(stream: Iterator[pa.RecordBatch], rows: int = PIECE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in order, ``rows`` at most in a batch: views, nothing is copied.

    A worker that makes Python values of a batch and new text from them holds it several
    times over; of a piece that is little, however many rows Spark sends at once.
    """
    for batch in stream:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Spark sends ``rows`` rows at a time to Python workers from here on.

    At the default of 10,000 a batch of texts takes tens of MB outside the heap for
    each task, beside what its worker holds.  The rows and results are the same.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


#: 64-bit words of a membership filter: 2 MB of bits for any number of keys.
FILTER_WORDS = 1 << 18


def with_maybe(df: DataFrame, h: str, keys: DataFrame, key: str, maybe: str) -> DataFrame:
    """``df`` with a boolean ``maybe``: false only where hash ``h`` is not among ``keys``.

    A filter of fixed size, joined by broadcast.  Rows that it clears need not
    be shuffled to meet ``keys``; the others are decided by a real join.
    """
    word = lambda c: F.pmod(F.shiftright(c, 6), F.lit(FILTER_WORDS))
    bit = lambda c: f"shiftleft(1L, cast({c} & 63 as int))"
    words = stored(keys.groupBy(word(F.col(key)).alias("_word")).agg(F.bit_or(F.expr(bit(key))).alias("_bits")), "key-filter")
    j = df.withColumn("_at", word(F.col(h))).join(F.broadcast(words), F.col("_at") == F.col("_word"), "left")
    return j.withColumn(maybe, F.coalesce(F.expr(f"(_bits & {bit(h)}) != 0"), F.lit(False))).drop("_at", "_word", "_bits")
