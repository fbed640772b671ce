"""Continuous scoring of incoming feature rows.

File source -> feature alignment -> model -> recency decay -> append sink.
The pipeline is stateless (each row is scored on its own), so no watermark
or state store is involved; the checkpoint records which input files were
processed, so a restarted or re-run query never scores a file twice and a
lost executor only re-runs its micro-batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shoplens.ml.train import batch_score


def start_scoring(
    spark: SparkSession,
    model: PipelineModel,
    feature_names: Sequence[str],
    schema: T.StructType,
    source_dir: str,
    sink_dir: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the scoring stream; ``available_now`` drains what is there and
    stops (batch-like runs and tests), otherwise runs on ``processing_time``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(source_dir)
    scored = batch_score(model, rows, feature_names)
    writer = scored.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint) \
        .outputMode("append")
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def replay_files(df: DataFrame, path: str, rows_per_file: int = 100_000) -> None:
    """Writes a table as the incoming files of a stream, each of bounded size."""
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)


def score_resumed(
    spark: SparkSession,
    model: PipelineModel,
    feature_names: Sequence[str],
    schema: T.StructType,
    source_dir: str,
    sink_dir: str,
    checkpoint: str,
    files_per_batch: int = 8,
    stop_after: int = 1,
) -> DataFrame:
    """Scores what lies in ``source_dir``, stopped after ``stop_after`` batches and resumed.

    The second query goes on from the first one's checkpoint, so each row is scored
    once wherever the first was stopped, within a batch too.  Returns the sink's rows.
    """
    run = lambda **how: start_scoring(spark, model, feature_names, schema, source_dir, sink_dir, checkpoint,
                                      max_files_per_trigger=files_per_batch, **how)
    first = run(available_now=False)
    try:
        while not first.awaitTermination(0.2):
            last = first.lastProgress
            if last and (last["batchId"] + 1 >= stop_after or not last["numInputRows"]):
                break
    finally:
        first.stop()
    run().awaitTermination()
    return spark.read.parquet(sink_dir)
