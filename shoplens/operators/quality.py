"""Data-quality checks.

Each check returns a findings DataFrame instead of mutating validator state;
``validate_all`` unions them and ``is_valid`` is the one action that turns the
findings into a pass/fail flag.  Column-wise statistics are computed in one
aggregate per table, never one job per column.

Findings schema: table, check, column, level ('error' | 'warning' | 'ok'),
value (double), detail (string).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions.dates import floor_days
from shoplens.operators.fingerprint import repeated_rows
from shoplens.operators.clean import numeric_columns, string_columns
from shoplens.operators.ranking import top_k_per_group

FINDINGS = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("check", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("level", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("detail", T.StringType()),
    ]
)

# Type names reported by the checks (pandas-style vocabulary).
TYPE_NAMES = {
    "bigint": "int64",
    "int": "int32",
    "smallint": "int16",
    "tinyint": "int8",
    "double": "float64",
    "float": "float32",
    "string": "object",
    "boolean": "bool",
    "timestamp": "datetime64[ns]",
    "timestamp_ntz": "datetime64[ns]",
    "date": "datetime64[ns]",
}


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], FINDINGS)


def _finding(table: str, check: str, column: Column, level: Column, value: Column, detail: Column) -> list[Column]:
    return [
        F.lit(table).alias("table"),
        F.lit(check).alias("check"),
        column.cast("string").alias("column"),
        level.alias("level"),
        value.cast("double").alias("value"),
        detail.cast("string").alias("detail"),
    ]


def _unpivot(df: DataFrame, cols: Sequence[str], name: str = "column", value: str = "value") -> DataFrame:
    """One row per (column, value) from a one-row wide aggregate."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    return df.selectExpr(f"stack({len(cols)}, {pairs}) as ({name}, {value})")


def validate_schema(df: DataFrame, required: Sequence[str], table: str = "table") -> DataFrame:
    """One error row per required column that is absent (schema only)."""
    spark = df.sparkSession
    missing = sorted(set(required) - set(df.columns))
    if not missing:
        return _empty(spark)
    rows = [(table, "schema", c, "error", 1.0, "missing required column") for c in missing]
    return spark.createDataFrame(rows, FINDINGS)


def missing_shares(df: DataFrame) -> DataFrame:
    """(column, share of null / NaN cells) for every column, one aggregate."""
    cols = df.columns
    aggs = []
    for c in cols:
        miss = F.col(c).isNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            miss = miss | F.isnan(F.col(c))
        aggs.append(F.avg(miss.cast("double")).alias(c))
    return _unpivot(df.agg(*aggs), cols, "column", "share")


def check_missing_values(df: DataFrame, max_missing_pct: float = 0.5, table: str = "table") -> DataFrame:
    """Error above ``max_missing_pct``, warning for 0 < share <= max.
    An empty table yields no findings (its shares are undefined)."""
    s = missing_shares(df).where(F.col("share") > 0)
    level = F.when(F.col("share") > max_missing_pct, "error").otherwise("warning")
    return s.select(*_finding(table, "missing_values", F.col("column"), level, F.col("share"),
                              F.format_string("%.4f missing", F.col("share"))))


def count_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row ``n_duplicates``: rows beyond the first of each group (nulls
    compare equal, as in a group-by)."""
    if not subset:
        return repeated_rows(df)
    keys = list(subset)
    return df.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n_duplicates"))


def check_duplicates(df: DataFrame, subset: Sequence[str] | None = None, table: str = "table") -> DataFrame:
    """D3: a warning when duplicate rows exist (never an error)."""
    label = ",".join(subset) if subset else "*"
    n = F.col("n_duplicates")
    return count_duplicates(df, subset).select(
        *_finding(table, "duplicates", F.lit(label), F.when(n > 0, "warning").otherwise("ok"), n,
                  F.format_string("%d duplicate rows", n))
    )


def type_name(dtype: T.DataType) -> str:
    s = dtype.simpleString()
    return TYPE_NAMES.get(s, s)


def check_data_types(df: DataFrame, expected: Mapping[str, str], table: str = "table") -> DataFrame:
    """Error when the expected name is not a substring of the actual type
    name; absent columns are skipped (schema only, no data pass)."""
    spark = df.sparkSession
    rows = []
    for col, want in expected.items():
        if col in df.columns:
            actual = type_name(df.schema[col].dataType)
            ok = want in actual
            rows.append((table, "data_types", col, "ok" if ok else "error", 0.0 if ok else 1.0,
                         f"expected {want}, got {actual}"))
    return spark.createDataFrame(rows, FINDINGS) if rows else _empty(spark)


def check_value_ranges(df: DataFrame, ranges: Mapping[str, tuple[float, float]], table: str = "table") -> DataFrame:
    """Count of values outside [min, max] per column (nulls not counted),
    every column in one aggregate."""
    present = [c for c in ranges if c in df.columns]
    if not present:
        return _empty(df.sparkSession)
    aggs = [F.count_if((F.col(c) < F.lit(ranges[c][0])) | (F.col(c) > F.lit(ranges[c][1]))).alias(c) for c in present]
    long = _unpivot(df.agg(*aggs), present, "column", "n")
    bounds = F.create_map(*[x for c in present for x in (F.lit(c), F.lit(f"[{ranges[c][0]}, {ranges[c][1]}]"))])
    n = F.col("n")
    return long.select(*_finding(table, "value_ranges", F.col("column"), F.when(n > 0, "error").otherwise("ok"), n,
                                 F.concat(n.cast("string"), F.lit(" values out of range "), bounds[F.col("column")])))


def check_data_freshness(
    df: DataFrame, date_column: str, max_age_days: int = 7, reference_date=None, table: str = "table"
) -> DataFrame:
    """age = floor days from ``reference_date`` (default: now) to the
    latest value; a warning when older than ``max_age_days``.  An absent
    column passes; values that do not parse fail."""
    spark = df.sparkSession
    if date_column not in df.columns:
        return spark.createDataFrame([(table, "freshness", date_column, "ok", 0.0, "column absent")], FINDINGS)
    ref = F.current_timestamp() if reference_date is None else F.lit(str(reference_date)).cast("timestamp")
    parsed = F.col(date_column).try_cast("timestamp")
    latest = df.agg(F.max(parsed).alias("_latest"), F.count_if(F.col(date_column).isNotNull() & parsed.isNull()).alias("_bad"))
    age = floor_days(ref, F.col("_latest"))
    level = F.when(F.col("_latest").isNull() | (F.col("_bad") > 0), "error").when(age > max_age_days, "warning").otherwise("ok")
    return latest.select(
        *_finding(table, "freshness", F.lit(date_column), level, age,
                  F.when(F.col("_bad") > 0, F.concat(F.col("_bad").cast("string"), F.lit(" values are no dates")))
                  .otherwise(F.concat(F.lit("latest record "), F.to_date("_latest").cast("string"))))
    )


def orphans(child: DataFrame, parent: DataFrame, child_fk: str, parent_pk: str) -> DataFrame:
    """Child rows whose key has no parent.  Null-safe equality, so a null
    key is an orphan unless the parent also holds a null."""
    p = parent.select(F.col(parent_pk).alias("_pk")).distinct()
    return child.join(p, child[child_fk].eqNullSafe(p["_pk"]), "left_anti")


def check_referential_integrity(
    child: DataFrame,
    parent: DataFrame,
    child_fk: str,
    parent_pk: str,
    child_table: str = "child",
    parent_table: str = "parent",
    samples: int = 5,
) -> DataFrame:
    """Orphan count plus up to ``samples`` example keys (the smallest,
    via a bounded top-k).  Missing columns give a passing warning."""
    spark = child.sparkSession
    label = f"{child_table}.{child_fk} -> {parent_table}.{parent_pk}"
    if child_fk not in child.columns or parent_pk not in parent.columns:
        return spark.createDataFrame(
            [(child_table, "referential_integrity", child_fk, "warning", 0.0, f"skipped: {label} column not found")],
            FINDINGS,
        )
    o = orphans(child.select(child_fk), parent, child_fk, parent_pk)
    n = o.agg(F.count(F.lit(1)).alias("_n"))
    ex = (
        o.select(F.col(child_fk).alias("_v")).distinct().orderBy(F.asc_nulls_first("_v")).limit(samples)
        .agg(F.concat_ws(",", F.array_sort(F.collect_list(F.col("_v").cast("string")))).alias("_ex"))
    )
    return n.crossJoin(ex).select(
        *_finding(child_table, "referential_integrity", F.lit(child_fk),
                  F.when(F.col("_n") > 0, "error").otherwise("ok"), F.col("_n"),
                  F.concat(F.lit(label + " e.g. "), F.coalesce(F.col("_ex"), F.lit(""))))
    )


def generate_quality_report(df: DataFrame, table_name: str = "table", top: int = 3) -> DataFrame:
    """D8 as long rows (table, column, metric, value, detail): row / column
    counts, nulls and dtype per column, duplicate rows, numeric mean / sample
    std / min / max, string distinct count and the ``top`` most common values
    (ties -> smaller value).  One wide aggregate plus one bounded top-k."""
    cols = df.columns
    nums = numeric_columns(df)
    strs = string_columns(df)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in cols:
        missing = F.col(c).isNull()
        if df.schema[c].dataType.typeName() in ("double", "float"):
            missing = missing | F.isnan(c)
        aggs.append(F.count_if(missing).alias(f"null_count|{c}"))
    for c in nums:
        x = F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
        aggs += [F.avg(x).alias(f"mean|{c}"), F.stddev_samp(x).alias(f"std|{c}"),
                 F.min(x).alias(f"min|{c}"), F.max(x).alias(f"max|{c}")]
    wide = df.agg(*aggs)
    names = [a for a in wide.columns]
    long = _unpivot(wide.select(*[F.col(f"`{n}`").cast("double").alias(n) for n in names]), names, "key", "value")
    long = long.select(
        F.lit(table_name).alias("table"),
        F.when(F.col("key") == "__rows", F.lit("*")).otherwise(F.split("key", r"\|").getItem(1)).alias("column"),
        F.when(F.col("key") == "__rows", F.lit("total_rows")).otherwise(F.split("key", r"\|").getItem(0)).alias("metric"),
        F.col("value"),
        F.lit(None).cast("string").alias("detail"),
    )
    spark = df.sparkSession
    meta = spark.createDataFrame(
        [(table_name, "*", "total_columns", float(len(cols)), None)]
        + [(table_name, f.name, "dtype", None, type_name(f.dataType)) for f in df.schema.fields],
        "table string, column string, metric string, value double, detail string",
    )
    dup = count_duplicates(df).select(
        F.lit(table_name).alias("table"), F.lit("*").alias("column"), F.lit("duplicate_rows").alias("metric"),
        F.col("n_duplicates").cast("double").alias("value"), F.lit(None).cast("string").alias("detail"),
    )
    parts = [long, meta, dup]
    if strs:
        pairs = ", ".join(f"'{c}', `{c}`" for c in strs)
        vals = df.selectExpr(f"stack({len(strs)}, {pairs}) as (column, v)").where(F.col("v").isNotNull())
        # Value counts serve both the distinct counts and the most common values.
        counts = vals.groupBy("column", "v").count()
        found = counts.groupBy("column").agg(F.count(F.lit(1)).cast("double").alias("_u"))
        names = spark.createDataFrame([(c,) for c in strs], "column string")
        parts.append(names.join(found, "column", "left").select(
            F.lit(table_name).alias("table"), "column", F.lit("unique_values").alias("metric"),
            F.coalesce("_u", F.lit(0.0)).alias("value"), F.lit(None).cast("string").alias("detail")))
        topk = top_k_per_group(counts, ["column"], [F.desc("count"), F.asc("v")], top, salt_on=["v"])
        parts.append(
            topk.select(
                F.lit(table_name).alias("table"), "column",
                F.concat(F.lit("top"), F.col("rank").cast("string")).alias("metric"),
                F.col("count").cast("double").alias("value"), F.col("v").alias("detail"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def validate_all(df: DataFrame, table_name: str, required_columns: Sequence[str] | None = None,
                 max_missing_pct: float = 0.5) -> DataFrame:
    """Schema, missing-value and duplicate findings for one table (see
    ``validate_with_report`` for the verdict and the quality report)."""
    parts = []
    if required_columns:
        parts.append(validate_schema(df, required_columns, table_name))
    parts.append(check_missing_values(df, max_missing_pct, table_name))
    parts.append(check_duplicates(df, None, table_name))
    return reduce(DataFrame.unionByName, parts)


def is_valid(findings: DataFrame) -> bool:
    """Valid when no finding is an error (duplicates only ever warn)."""
    return findings.where(F.col("level") == "error").limit(1).count() == 0


def validate_with_report(df: DataFrame, table_name: str, required_columns: Sequence[str] | None = None,
                         max_missing_pct: float = 0.5) -> tuple[bool, DataFrame, DataFrame]:
    """D9 in full: (valid, findings, quality report) of one table."""
    findings = validate_all(df, table_name, required_columns, max_missing_pct)
    return is_valid(findings), findings, generate_quality_report(df, table_name)
