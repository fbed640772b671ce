"""Token ids in ORC files, written in ascending document order and read back.

Each file is one range of document ids: integer run-length encoded columns,
a row index every ``row_index`` rows and a Bloom filter on the document id,
so a reader can take stripes in parallel and skip those that cannot hold a
wanted id.  Spark's own ORC source writes and reads them.

Defined cases: a null text is the empty text (only the end id); null ids come
first; rows of one id are ordered by their text's hash, equal rows in any
order (their results are the same but for ``start``).  Only the id and text
columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm import tokens
from shoplens.llm.common import shared_path, text_or_empty
from shoplens.session import ship_package

SCHEMA = "doc_id long, part int, place long, before long, ids array<int>"


def token_rows(path: str, end_id: int, spaced: bool, pattern: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (doc_id, text, part), in order -> batches of SCHEMA.

    ``place`` and ``before`` count the rows and ids that precede in the part.
    """

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        cache = tokens.library_encoder(path, spaced, tokens.split_words(pattern))
        tail = tokens.packed([end_id])
        place = before = 0
        for batch in stream:
            at = 0
            for texts in tokens.text_runs(batch.column(1)):
                raw = [x + tail for x in cache.ids(texts)]
                n = np.array([len(x) // 4 for x in raw], dtype=np.int64)
                ends = np.cumsum(n)
                ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)),
                                               pa.array(np.frombuffer(b"".join(raw), dtype="<i4")))
                rows = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, rows), batch.column(2).slice(at, rows),
                     pa.array(np.arange(place, place + rows)), pa.array(before + ends - n), ids],
                    names=["doc_id", "part", "place", "before", "ids"])
                at += rows
                place += rows
                before += int(ends[-1])

    return run


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int, spaced: bool, pattern: str,
              id_col: str = "doc_id", text_col: str = "text", row_index: int = 1000) -> None:
    """Range-partitions by id (texts travel, not the larger ids), encodes, writes."""
    ship_package(docs.sparkSession)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
         .withColumn("_tie", F.xxhash64("text")).repartitionByRange(n, "doc_id", "_tie")
         .sortWithinPartitions("doc_id", "_tie").select("doc_id", "text", F.spark_partition_id().alias("part")))
    (d.mapInArrow(token_rows(tokenizer, end_id, spaced, pattern), SCHEMA)
     .write.option("orc.bloom.filter.columns", "doc_id").option("orc.row.index.stride", row_index)
     .option("orc.stripe.size", 16 << 20).option("compression", "zstd").orc(path))


def crc_of_ids(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in stream:
        ids = batch.column(3)
        raw, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
        sums = [zlib.crc32(raw[i:j].astype("<u4", copy=False)) for i, j in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array((ends[1:] - ends[:-1]).astype("int64")), pa.array(sums, pa.int64())],
            names=["doc_id", "part", "before", "n_tokens", "ids_crc32"])


def read_ids(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of written files.

    Only one total per file is gathered and summed in file order; the rows
    themselves already carry their place inside their file.
    """
    rows = files.select("doc_id", "part", "before", "ids").mapInArrow(
        crc_of_ids, "doc_id long, part int, before long, n_tokens long, ids_crc32 long")
    totals = files.groupBy("part").agg(F.max(F.col("before") + F.size("ids")).alias("total"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(upto), F.lit(0)).alias("offset"))
    return (rows.join(offsets, "part").select("doc_id", (F.col("offset") + F.col("before")).alias("start"),
                                              "n_tokens", "ids_crc32"))


def id_files(docs: DataFrame, tokenizer: str, end_id: int, spaced: bool, pattern: str, **columns: str) -> DataFrame:
    """Writes the ids of ``docs`` to the shared folder and opens the files."""
    spark = docs.sparkSession
    path = shared_path(spark, "token-ids")
    write_ids(docs, path, tokenizer, end_id, spaced, pattern, **columns)
    return spark.read.schema(SCHEMA).orc(path)
