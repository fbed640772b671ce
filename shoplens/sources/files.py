"""File sources (S1-S4): declared schemas, no inference.

Ids are strings, as the shop's files have them (``U00001``).  Paths are only
opened by Spark's readers, so any store that Spark reads will do.  CSV columns
are taken by the names in the header, in whatever order; an absent column and a
file whose header differs from that of the others fail the read.  A row that
does not fit the declared types fails the read too, or is written aside with
its reason, if a place for such rows is given.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.schema import TABLES

REQUIRED_TABLES = ["users", "products", "sessions", "browse_events", "orders", "order_items"]


def _if_there(open_: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame, or None where its path does not exist."""
    try:
        return open_()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


_WHOLE = "_whole_row"


def _csv_rows(spark: SparkSession, path: str, name: str) -> tuple[DataFrame, list[str], Column]:
    """Rows as strings under the header's names, those names, and the reason why a row does not fit."""
    header = [c.strip() for c in spark.read.option("header", True).csv(path).columns]
    absent = [f.name for f in TABLES[name].fields if f.name not in header]
    if absent:
        raise ValueError(f"{path}: columns absent from the header: {', '.join(absent)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _WHOLE]])
    # Every file's header is held against the schema; rows are parsed in full,
    # so that one with too few or too many values is seen.
    rows = (spark.read.option("header", True).option("enforceSchema", False).option("ignoreLeadingWhiteSpace", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _WHOLE).option("columnPruning", False)
            .schema(schema).csv(path))
    reason = F.when(F.col(_WHOLE).isNotNull(), F.lit("malformed row"))
    for f in TABLES[name].fields:
        value = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, T.StringType):
            reason = reason.when(value.isNotNull() & value.try_cast(f.dataType).isNull(), F.lit(f"could not parse {f.name}"))
    return rows, header, reason


def read_csv(spark: SparkSession, path: str, name: str, rejects: str | None = None) -> DataFrame:
    """One table from CSV (header row expected), columns by name.

    A declared table has its declared columns and types; others have strings.
    With ``rejects`` rows that do not fit are written there as Parquet (file, row,
    reason), in one pass before the table is returned; without, reading one fails.
    """
    if name not in TABLES:
        return spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
    rows, header, reason = _csv_rows(spark, path, name)
    if rejects is None:
        fits = F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit(f"{name}: "), reason)).cast("boolean")).otherwise(F.lit(True))
    else:
        text = F.coalesce(F.col(_WHOLE), F.to_csv(F.struct(*[F.col(f"`{c}`") for c in header])))
        (rows.withColumn("file", F.col("_metadata.file_path")).withColumn("reason", reason).where("reason IS NOT NULL")
         .select("file", text.alias("row"), "reason").write.mode("append").parquet(rejects))
        fits = reason.isNull()
    return rows.where(fits).select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in TABLES[name].fields])


def load_raw(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """Every ``*.csv`` file or folder in ``data_dir``, keyed by stem, sorted."""
    found = _if_there(lambda: spark.read.format("binaryFile").load(f"{data_dir}/*.csv").select("path"))
    if found is None:
        return {}
    # one row per table: bounded by the tables of the folder
    stem = F.regexp_extract("path", r"([^/]+)\.csv(?:/[^/]*)?$", 1)
    names = sorted(r[0] for r in found.select(stem).distinct().collect())
    return {n: read_csv(spark, f"{data_dir}/{n}.csv", n) for n in names}


def load_tables(spark: SparkSession, data_dir: str, names: Sequence[str] = REQUIRED_TABLES,
                required: bool = True) -> dict[str, DataFrame]:
    """The named tables from ``<dir>/<name>.csv``.  ``required``
    raises FileNotFoundError naming the first absent table before any job
    starts; otherwise absent tables are skipped."""
    out = {}
    for n in names:
        path = f"{data_dir}/{n}.csv"
        df = _if_there(lambda: read_csv(spark, path, n))  # noqa: B023 - called at once
        if df is not None:
            out[n] = df
        elif required:
            raise FileNotFoundError(f"required table file not found: {path}")
    return out


def load_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame | None:
    """Parquet first (a file or folder ``<name>.parquet``), CSV fallback;
    None when neither exists."""
    df = _if_there(lambda: spark.read.parquet(f"{data_dir}/{name}.parquet"))
    return df if df is not None else _if_there(lambda: read_csv(spark, f"{data_dir}/{name}.csv", name))
