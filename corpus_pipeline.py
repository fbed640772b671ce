"""The corpus pipeline: five stages over ``documents``.

Each stage reads what the one before kept, written as Parquet; all but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm import jaccard, line_quality, packing, pii, toxicity
from shoplens.llm.common import small_batches, stored, table

#: Pieces of text that a worker of the last stage remembers: its executor's heap is full
#: by then from the stages before, which leaves the workers less than they have alone.
REMEMBERED = 150_000


def _like_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars of the present text."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: boilerplate lines go, rejected documents go."""
    return _like_documents(line_quality.clean_documents(docs))


def non_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go."""
    small_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the smallest id."""
    small_batches(spark)
    return jaccard.one_of_each(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    small_batches(spark)
    return _like_documents(pii.redacted(docs, pii.train(docs)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of at most 1024 tokens."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), 2, True, public_tokenizers.PATTERN, 1024,
                        remembered=REMEMBERED)


STAGES = [("quality", quality), ("toxicity", non_toxic), ("near_duplicates", distinct_documents),
          ("personal_data", private), ("packing", packed)]

#: The stages hold models and a tokeniser, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
