"""Cleaning operators (P1-P10, P15, A20, A21) and the table-level pipeline.

Global statistics (quantile caps, maxima, medians, modes) are computed as
one-row aggregates and broadcast back with a cross join, so every operator
stays a lazy plan with no driver round trip.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.functions.dates import floor_days
from shoplens.functions.scalar import age_group, clip_upper, ordinal_encode
from shoplens.operators.fingerprint import distinct_rows
from shoplens.operators.ranking import exact_quantiles, keep_first, quantile_values_multi
from shoplens.schema import DATETIME_COLUMNS, MEMBERSHIP_ORDER, PREMIUM_TIERS, STATUS_ORDER

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def parse_datetimes(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """session_start/end and order_date to timestamp, signup_date to date."""
    out = dict(tables)
    for name, cols in DATETIME_COLUMNS.items():
        if name not in out:
            continue
        df = out[name]
        for c in cols:
            if c in df.columns:
                kind = "date" if c == "signup_date" else "timestamp"
                df = df.withColumn(c, F.col(c).cast(kind))
        out[name] = df
    return out


def clip_outliers(df: DataFrame, col: str, percentile: float = 0.95, out_col: str | None = None) -> DataFrame:
    """Upper-winsorise ``col`` at its exact (interpolated) quantile.

    Nulls stay null.  The cap is a one-row frame joined back by broadcast.
    """
    cap = exact_quantiles(df, col, [percentile], ["_cap"])
    return (
        df.crossJoin(F.broadcast(cap))
        .withColumn(out_col or col, clip_upper(F.col(col), F.col("_cap")))
        .drop("_cap")
    )


def log_transform(df: DataFrame, col: str, new_col: str | None = None) -> DataFrame:
    """ln(1 + x) into ``new_col`` (default ``<col>_log``)."""
    return df.withColumn(new_col or f"{col}_log", F.log1p(F.col(col)))


def encode_ordinal(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """``<col>_encoded`` = position in ``order``; unknown -> null."""
    return df.withColumn(f"{col}_encoded", ordinal_encode(F.col(col), order))


def handle_missing_values(df: DataFrame, strategy: str = "median") -> DataFrame:
    """Numeric nulls -> median (interpolated) or mean; string nulls ->
    most frequent value, ties to the smallest.

    The fill values are scalars: all medians come from one multi-column
    exact-quantile pass, all means and modes from one aggregate; they are
    applied as a one-row literal frame, so the output plan reads ``df`` once.
    """
    nums = numeric_columns(df)
    strs = string_columns(df)
    if not nums and not strs:
        return df
    fills: dict[str, object] = {}
    if nums and strategy == "median":
        med = quantile_values_multi(df, {c: [0.5] for c in nums})
        fills.update({c: med[c][0] for c in nums})
    if strs:
        fills.update(modes(df, strs))
    if nums and strategy != "median":
        row = df.agg(*[F.avg(c).alias(c) for c in nums]).first()
        fills.update(row.asDict())
    out = df
    for c in nums:
        v = fills.get(c)
        if v is None:
            continue
        dtype = df.schema[c].dataType
        fill = F.lit(float(v)).cast(dtype)
        filled = F.coalesce(F.col(c), fill)
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            filled = F.when(F.isnan(F.col(c)), fill).otherwise(filled)
        out = out.withColumn(c, filled)
    for c in strs:
        if fills.get(c) is not None:
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(fills[c])))
    return out.select(*df.columns)


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column, the smallest among equals; null for a column of nulls.

    Values are counted first, so no buffer holds all distinct values of a
    column; what reaches the driver is one row per column.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("_c"), F.col(f"`{c}`").alias("_v")) for i, c in enumerate(cols)]))
    counts = (df.select(pairs.alias("_p")).select("_p.*").where(F.col("_v").isNotNull())
              .groupBy("_c", "_v").agg(F.count(F.lit(1)).alias("_n")))
    best = counts.groupBy("_c").agg(F.min(F.struct((-F.col("_n")).alias("n"), F.col("_v").alias("v"))).alias("_b"))
    found = {cols[r["_c"]]: r["v"] for r in best.select("_c", "_b.v").collect()}
    return {c: found.get(c) for c in cols}


def remove_duplicates(df: DataFrame, pk_col: str | None = None, order_by: Sequence[str] | None = None) -> DataFrame:
    """Drop exact duplicate rows; with ``pk_col`` keep the first row per
    key by ``order_by`` (Spark rows have no inherent order, so name one)."""
    if pk_col and pk_col in df.columns:
        return keep_first(df, [pk_col], list(order_by or [c for c in df.columns if c != pk_col]))
    return distinct_rows(df)


# --------------------------------------------------------------------- tables

def clean_sessions(sessions: DataFrame) -> DataFrame:
    """P2 + P15 + P9 + P10 on sessions: duration capped at p95 and pages at
    p99 (renamed ``*_clean``), bounced as 0/1, engagement score.  Both caps
    come from the same input, so one pass of the session table serves both."""
    q = quantile_values_multi(sessions, {"duration_secs": [0.95], "pages_visited": [0.99]})
    dcap, pcap = q["duration_secs"][0], q["pages_visited"][0]
    caps = sessions.sparkSession.createDataFrame([(dcap, pcap)], "_dcap double, _pcap double")
    s = sessions.crossJoin(F.broadcast(caps)).select(
        *[c for c in sessions.columns if c not in ("duration_secs", "pages_visited", "bounced")],
        clip_upper(F.col("duration_secs"), F.col("_dcap")).alias("duration_secs_clean"),
        clip_upper(F.col("pages_visited"), F.col("_pcap")).alias("pages_visited_clean"),
        F.col("bounced").cast("int").alias("bounced"),
    )
    page_max = s.agg(F.max("pages_visited_clean").alias("_pmax"))
    return (
        s.crossJoin(F.broadcast(page_max))
        .withColumn(
            "engagement_score",
            F.round(
                F.col("pages_visited_clean") / F.col("_pmax") * 0.5 + (1 - F.col("bounced")) * 0.5, 4
            ),
        )
        .drop("_pmax")
    )


def clean_orders(orders: DataFrame) -> DataFrame:
    """Amount capped at p95, ``log_total_amount``, ``status_encoded``."""
    o = clip_outliers(orders, "total_amount", 0.95)
    o = log_transform(o, "total_amount", "log_total_amount")
    return encode_ordinal(o, "status", STATUS_ORDER)


def clean_users(users: DataFrame, orders: DataFrame | None, buyers: DataFrame | None = None) -> DataFrame:
    """membership_encoded, is_premium, age_group, account_age_days (floor days
    from the latest order, >= 0) and will_purchase (user is a buyer).

    ``buyers`` (one column ``user_id``) defaults to every user with an order.
    """
    u = encode_ordinal(users, "membership", MEMBERSHIP_ORDER)
    u = u.withColumn("is_premium", F.col("membership").isin(PREMIUM_TIERS).cast("int"))
    u = u.withColumn("age_group", age_group("age"))
    if orders is not None:
        ref = orders.agg(F.max("order_date").cast("timestamp").alias("_ref"))
    else:
        ref = u.sparkSession.range(1).select(F.current_timestamp().alias("_ref"))
    u = (
        u.crossJoin(F.broadcast(ref))
        .withColumn("account_age_days", F.greatest(floor_days(F.col("_ref"), F.col("signup_date")), F.lit(0)))
        .drop("_ref")
    )
    return with_membership_flag(u, buyers if buyers is not None else orders, "will_purchase")


def with_membership_flag(df: DataFrame, keys: DataFrame | None, out_col: str, key: str = "user_id") -> DataFrame:
    """0/1 flag for "key appears in ``keys``" as a left join to the
    distinct keys (semi-join that keeps every row)."""
    if keys is None:
        return df.withColumn(out_col, F.lit(0))
    marks = keys.select(key).distinct().withColumn("_mark", F.lit(1))
    return df.join(marks, key, "left").withColumn(out_col, F.coalesce(F.col("_mark"), F.lit(0))).drop("_mark")


def clean_browse_events(events: DataFrame) -> DataFrame:
    """time spent capped at p95 (``time_spent_secs_clean``), cart / wishlist flags."""
    b = clip_outliers(events, "time_spent_secs", 0.95, "time_spent_secs_clean").drop("time_spent_secs")
    return b.withColumn("added_to_cart", (F.col("event_type") == "add_to_cart").cast("int")).withColumn(
        "wishlisted", (F.col("event_type") == "add_to_wishlist").cast("int")
    )


def clean_data(tables: dict[str, DataFrame], buyers: DataFrame | None = None) -> dict[str, DataFrame]:
    """The full cleaning pass over whichever of the six tables are present."""
    t = parse_datetimes(tables)
    out = dict(t)
    if "sessions" in t:
        out["sessions"] = clean_sessions(t["sessions"])
    if "orders" in t:
        out["orders"] = clean_orders(t["orders"])
    if "users" in t:
        out["users"] = clean_users(t["users"], t.get("orders"), buyers)
    if "browse_events" in t:
        out["browse_events"] = clean_browse_events(t["browse_events"])
    return out
