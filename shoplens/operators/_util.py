"""Small shared helpers for operators."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from shoplens.session import checkpoint_dir


def materialize(df: DataFrame, mode: str = "persist") -> DataFrame:
    """Pin an intermediate that several downstream passes reuse.

    ``persist`` keeps the lineage (a lost executor's blocks are recomputed);
    ``checkpoint`` writes to the shared ``spark.checkpoint.dir`` and cuts the
    lineage, for long plans.  ``none`` returns the frame unchanged.
    """
    if mode == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if mode == "checkpoint":
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder: later passes read the
    same rows in the same partitions, and a lost executor costs a re-read."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
