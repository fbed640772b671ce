"""Repeated whole rows without moving whole rows.

Grouping a table by all its columns shuffles every byte of it.  Here each row
gets a 128-bit fingerprint, and only fingerprints are counted.  Rows whose
fingerprint occurs once are unlike any other and stay where they are; only those
that may meet another row are shuffled in full and compared by value.  So
the result is exact whatever the fingerprints do.

Rows that may meet are told by a bit table of fixed size, joined by broadcast.
Nulls equal nulls, as in a group-by.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.operators._util import written

#: 64-bit words of the bit table: 2 MB for any number of rows.
WORDS = 1 << 18


def row_fingerprint(cols: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the values and of which of them are null."""
    values = [F.col(f"`{c}`") for c in cols]
    nulls = [v.isNull() for v in values]
    return [F.xxhash64(F.lit(seed), *nulls, *values) for seed in (1, 2)]


def with_meeting(df: DataFrame, cols: Sequence[str] | None = None,
                 fingerprint: Callable[[Sequence[str]], list[Column]] = row_fingerprint) -> DataFrame:
    """``df`` with a boolean ``_meets``: false only for rows unlike any other in ``cols``."""
    cols = list(cols or df.columns)
    a, b = fingerprint(cols)
    seen = df.select(a.alias("_a"), b.alias("_b")).groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    word = lambda c: F.pmod(F.shiftright(c, 6), F.lit(WORDS))
    bit = lambda c: f"shiftleft(1L, cast({c} & 63 as int))"
    table = written(seen.groupBy(word(F.col("_a")).alias("_word")).agg(F.expr(f"bit_or({bit('_a')})").alias("_bits")), "repeats")
    j = df.withColumn("_a", a).withColumn("_at", word(F.col("_a"))).join(F.broadcast(table), F.col("_at") == F.col("_word"), "left")
    meets = F.coalesce(F.expr(f"(_bits & {bit('_a')}) != 0"), F.lit(False))
    return j.withColumn("_meets", meets).drop("_a", "_at", "_word", "_bits")


def repeated_rows(df: DataFrame, fingerprint: Callable[[Sequence[str]], list[Column]] = row_fingerprint) -> DataFrame:
    """One row ``n_duplicates``: rows beyond the first of each group of equal rows."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    groups = with_meeting(df, None, fingerprint).where("_meets").groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"))


def distinct_rows(df: DataFrame, fingerprint: Callable[[Sequence[str]], list[Column]] = row_fingerprint) -> DataFrame:
    """``df`` with one of each group of equal rows."""
    marked = with_meeting(df, None, fingerprint)
    return marked.where("NOT _meets").drop("_meets").unionByName(marked.where("_meets").drop("_meets").dropDuplicates())
