"""Exploratory and KPI aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.functions.scalar import exact_avg, exact_sum
from shoplens.operators._util import written
from shoplens.operators.fingerprint import repeated_rows
from shoplens.operators.clean import numeric_columns
from shoplens.operators.ranking import exact_quantiles


def distribution(df: DataFrame, col: str, levels: Sequence[str] | None = None) -> DataFrame:
    """Value counts with percentage of rows.  With ``levels`` the output
    has exactly those values in that order (absent ones count 0); the level
    table is a literal of the given size, joined after aggregation."""
    total = df.agg(F.count(F.lit(1)).alias("_n"))
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    if levels is not None:
        lv = df.sparkSession.createDataFrame([(v, i) for i, v in enumerate(levels)], f"{col} string, level_order int")
        counts = lv.join(counts, col, "left").withColumn("count", F.coalesce("count", F.lit(0)))
    out = counts.crossJoin(F.broadcast(total)).withColumn(
        "pct", F.col("count").cast("double") * F.lit(100.0) / F.col("_n").cast("double")
    )
    order = ["level_order"] if levels is not None else [F.desc("count"), F.col(col)]
    return out.orderBy(*order).select(col, F.col("count").cast("long").alias("count"), "pct")


def group_rate(df: DataFrame, group: str, flag: str, name: str = "rate") -> DataFrame:
    """A10: percentage of rows with ``flag`` = 1 per group, plus group size."""
    return df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        (F.avg(F.col(flag).cast("double")) * F.lit(100.0)).alias(name),
    )


def count_by_month(df: DataFrame, ts: str, name: str = "month") -> DataFrame:
    """Rows per calendar month (``YYYY-MM``)."""
    return df.groupBy(F.date_format(F.col(ts), "yyyy-MM").alias(name)).agg(F.count(F.lit(1)).alias("count"))


def count_by_hour(df: DataFrame, ts: str, name: str = "hour_of_day") -> DataFrame:
    """Rows per hour of day."""
    return df.groupBy(F.hour(F.col(ts)).alias(name)).agg(F.count(F.lit(1)).alias("count"))


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max] (last bin closed) with counts and
    the overall mean as a marker column.  min / max / mean are one broadcast
    row; bins without rows have count 0 (no bins for an empty column, one for a
    constant one)."""
    stats = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"), exact_avg(col).alias("mean"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    b = F.least(F.floor((F.col(col) - F.col("_lo")) / w), F.lit(bins - 1)).cast("int")
    binned = df.where(F.col(col).isNotNull()).crossJoin(F.broadcast(stats)).withColumn(
        "bin", F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(b)
    )
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("_n"))
    every = stats.where(F.col("_lo").isNotNull()).withColumn("bin", F.explode(F.sequence(
        F.lit(0), F.when(F.col("_hi") == F.col("_lo"), 0).otherwise(bins - 1))))
    g = every.join(counts, "bin", "left").withColumn("count", F.coalesce("_n", F.lit(0).cast("long")))
    return g.select(
        "bin",
        (F.col("_lo") + F.col("bin") * w).alias("lower"),
        (F.col("_lo") + (F.col("bin") + 1) * w).alias("upper"),
        "count",
        "mean",
    )


def count_by_dimension(facts: DataFrame, dim: DataFrame, key: str, attr: str) -> DataFrame:
    """A13 (+ J2): facts per dimension attribute via a left join (facts
    without a dimension row count under a null attribute)."""
    # Facts are counted per key before the join: a row per key is shuffled, not one per fact.
    counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.join(dim.select(key, attr), key, "left").groupBy(attr).agg(F.sum("_n").alias("count"))


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns, null cells and duplicate rows per table; one
    aggregate per table, and one of row fingerprints."""
    parts = []
    for name, df in tables.items():
        nulls = reduce(lambda a, b: a + b, [F.count_if(F.col(c).isNull()) for c in df.columns])
        base = df.agg(F.count(F.lit(1)).alias("rows"), nulls.alias("null_cells"))
        parts.append(
            base.crossJoin(F.broadcast(repeated_rows(df))).select(
                F.lit(name).alias("table"),
                "rows",
                F.lit(len(df.columns)).alias("columns"),
                "null_cells",
                F.col("n_duplicates").alias("duplicate_rows"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def kpis(users: DataFrame, orders: DataFrame, products: DataFrame, events: DataFrame) -> DataFrame:
    """Headline counts and buyer rate = distinct ordering users / users."""
    u = users.agg(F.count(F.lit(1)).alias("users"))
    o = orders.agg(F.count(F.lit(1)).alias("orders"), F.countDistinct("user_id").alias("_buyers"))
    p = products.agg(F.count(F.lit(1)).alias("products"))
    e = events.agg(F.count(F.lit(1)).alias("events"))
    return u.crossJoin(o).crossJoin(p).crossJoin(e).select(
        "users", "orders", "products", "events",
        (F.col("_buyers").cast("double") * 100.0 / F.col("users").cast("double")).alias("buyer_rate"),
    )


def customer_stats(fm: DataFrame, target: str = "will_purchase") -> DataFrame:
    """Total customers, high-value customers (spend above the exact
    median), mean order value, total revenue, purchase rate."""
    med = exact_quantiles(fm, "total_spend", [0.5], ["_med"])
    return fm.crossJoin(F.broadcast(med)).agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(F.col("total_spend") > F.col("_med")).alias("high_value_customers"),
        exact_avg("avg_order_value").alias("avg_order_value"),
        exact_sum("total_spend").alias("total_revenue"),
        F.avg(F.col(target).cast("double")).alias("purchase_rate"),
    )


def target_balance(df: DataFrame, target: str) -> DataFrame:
    """Buyers, non-buyers and the buyer share."""
    return df.agg(
        F.sum(F.col(target)).cast("long").alias("buyers"),
        (F.count(F.lit(1)) - F.sum(F.col(target))).cast("long").alias("non_buyers"),
        F.avg(F.col(target).cast("double")).alias("share"),
    )


def target_correlation(df: DataFrame, target: str, exclude: Sequence[str] = ("user_id",), top: int | None = None) -> DataFrame:
    """|Pearson r| of every numeric column with the target, largest
    first; a constant column gives null (``try_divide``) instead of the
    divide-by-zero ``corr`` raises under ANSI mode.  All columns in one
    aggregate, then unpivoted."""
    cols = [c for c in numeric_columns(df, list(exclude) + [target])]
    # Means first, then plain sums of products of deviations: short expressions
    # that one pass adds up, and no cancellation of large means.  Both passes read
    # the written numbers, so the columns are computed once.
    df = written(df.select(F.col(target).cast("double").alias("_t"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)]),
                 "numbers")
    t = F.col("_t")
    x = {c: F.col(f"_x{i}") for i, c in enumerate(cols)}
    means = df.agg(F.avg(t).alias("_t"), *[F.avg(v).alias(f"m{i}") for i, v in enumerate(x.values())]).first()
    dt = t - F.lit(means["_t"])
    sums = []
    for i, v in enumerate(x.values()):
        dx = v - F.lit(means[f"m{i}"])
        sums += [F.sum(dx * dt).alias(f"xy{i}"), F.sum(F.when(t.isNotNull(), dx * dx)).alias(f"xx{i}"),
                 F.sum(F.when(v.isNotNull(), dt * dt)).alias(f"yy{i}")]
    parts = ", ".join(f"'{c}', abs(try_divide(xy{i}, sqrt(xx{i}) * sqrt(yy{i})))" for i, c in enumerate(cols))
    long = df.agg(*sums).selectExpr(f"stack({len(cols)}, {parts}) as (feature, abs_corr)")
    ordered = long.orderBy(F.desc_nulls_last("abs_corr"), "feature")
    return ordered.limit(top) if top else ordered


def top_products(events: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """T1 + J3: the ``k`` most browsed products (aggregate first, then join
    the dimension, inner), ties by product id."""
    counts = events.groupBy("product_id").agg(F.count(F.lit(1)).alias("browse_count"))
    joined = counts.join(products.select("product_id", "product_name", "category", "price"), "product_id", "inner")
    return joined.orderBy(F.desc("browse_count"), "product_id").limit(k)
