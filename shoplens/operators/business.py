"""Business tables over scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.operators.metrics import first_at_or_above
from shoplens.operators.ranking import global_rank

# Fixed rule values of the original scoring and campaign logic.
CAMPAIGN_DEPTHS = [0.10, 0.20, 0.30, 0.40, 0.50, 1.00]
DEFAULT_AOV, DEFAULT_COST_PER_USER, DEFAULT_UPLIFT = 50.0, 0.5, 0.15
RISK_HIGH, RISK_MEDIUM, PROMO_AT = 0.6, 0.4, 0.5


def campaign_table(lift: DataFrame, depths: Sequence[float] = CAMPAIGN_DEPTHS, avg_order: float = DEFAULT_AOV,
                   cost_per_user: float = DEFAULT_COST_PER_USER, uplift: float = DEFAULT_UPLIFT,
                   tolerance: float = 0.0) -> DataFrame:
    """Per targeting depth -- users targeted int(n * p), buyers captured
    (cumulative at the first row reaching the depth), revenue = captured x
    order value x uplift, cost, profit, ROI % (0 when cost is 0)."""
    rows = first_at_or_above(lift, depths, tolerance)
    targeted = F.floor(F.col("n_total") * F.col("pct")).cast("long")
    revenue = F.col("cum_buyers") * F.lit(avg_order) * F.lit(uplift)
    cost = targeted * F.lit(cost_per_user)
    return rows.select(
        "pct",
        targeted.alias("targeted"),
        F.col("cum_buyers").alias("captured"),
        "pct_captured",
        "lift",
        revenue.alias("revenue"),
        cost.alias("cost"),
        (revenue - cost).alias("profit"),
        F.when(cost > 0, (revenue - cost) / cost * 100).otherwise(F.lit(0.0)).alias("roi"),
    )


def roi_curve(lift: DataFrame, step: float = 0.05, **kw) -> DataFrame:
    """The campaign table at depths step, 2*step, ... 1 (matched with a
    0.001 tolerance) and an ``is_best`` flag on the highest-ROI depth (ties
    -> shallower)."""
    n = int(round(1.0 / step))
    depths = [step + i * step for i in range(n)]
    t = campaign_table(lift, depths, tolerance=0.001, **kw).select("pct", "roi", "revenue", "cost")
    best = t.agg(F.max(F.struct(F.col("roi").alias("r"), (-F.col("pct")).alias("np"))).alias("_b"))
    best = best.select((-F.col("_b.np")).alias("_bp"))
    return t.crossJoin(F.broadcast(best)).withColumn("is_best", F.col("pct") == F.col("_bp")).drop("_bp")


# Share of a score that is kept after so many whole days without an order
# (fixed values); without any order, after more than so many days.
DECAY_AFTER_DAYS = [(180, 0.25), (150, 0.35), (120, 0.5), (91, 0.7)]
IDLE_WITHOUT_ORDERS = (60, 0.3)


def decayed_score(p: Column, days_since_last_order: Column, total_orders: Column) -> Column:
    """Recency decay of a purchase probability."""
    d, n = days_since_last_order, total_orders
    factor = F.when((n == 0) & (d > IDLE_WITHOUT_ORDERS[0]), IDLE_WITHOUT_ORDERS[1])
    for days, keep in DECAY_AFTER_DAYS:
        factor = factor.when((n > 0) & (d >= days), keep)
    return p * factor.otherwise(1.0)


def apply_decay(df: DataFrame, prob: str = "probability") -> DataFrame:
    """P17 on a frame: ``adjusted_probability`` and ``prediction`` (>= 0.5)."""
    adj = decayed_score(F.col(prob), F.col("days_since_last_order"), F.col("total_orders"))
    return df.withColumn("adjusted_probability", adj).withColumn(
        "prediction", (F.col("adjusted_probability") >= 0.5).cast("int")
    )


def risk_tier(p: Column) -> Column:
    """High / Medium / Low."""
    return F.when(p >= RISK_HIGH, "High").when(p >= RISK_MEDIUM, "Medium").otherwise("Low")


def recommended_action(p: Column) -> Column:
    return F.when(p >= PROMO_AT, "Send promo email").otherwise("Nurture campaign")


def driver_scores(fm: DataFrame) -> DataFrame:
    """Indicative per-user driver strengths, unpivoted and ranked within
    the user (seven rows per user, so the window is bounded)."""
    scores = {
        "Cart-add rate": F.col("cart_add_rate") * 3,
        "Total sessions": F.least(F.col("total_sessions") / 100, F.lit(1.0)),
        "Engagement score": F.col("engagement_score_mean").cast("double"),
        "Membership tier": F.col("membership_encoded") / 3,
        "Account age": F.least(F.col("account_age_days") / 500, F.lit(1.0)),
        "Unique categories": F.col("unique_categories_browsed") / 6,
        "Days since last session": F.greatest(F.lit(0.0), 1 - F.col("days_since_last_session") / 180),
    }
    wide = fm.select("user_id", *[v.cast("double").alias(f"d{i}") for i, v in enumerate(scores.values())])
    pairs = ", ".join(f"'{k}', d{i}" for i, k in enumerate(scores))
    long = wide.selectExpr("user_id", f"stack({len(scores)}, {pairs}) as (driver, score)")
    w = Window.partitionBy("user_id").orderBy(F.desc("score"), "driver")
    return long.withColumn("rank", F.row_number().over(w))


def top_buyers(scored: DataFrame, prob: str = "probability", k: int = 20, id_col: str = "user_id") -> DataFrame:
    """The ``k`` highest scores (ties by id) with a rank-based action."""
    top = scored.select(id_col, prob).orderBy(F.desc(prob), id_col).limit(k)
    # at most k rows after the limit, so one ordered window is bounded
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(prob), id_col)).cast("long"))
    action = (
        F.when(F.col("rank") <= 5, "Priority email").when(F.col("rank") <= 15, "Standard email")
        .otherwise("Push notification")
    )
    return ranked.withColumn("recommended_action", action)


def customer_listing(fm: DataFrame, limit: int = 100, id_col: str = "user_id") -> DataFrame:
    """The first ``limit`` customers by id plus the total count."""
    total = fm.agg(F.count(F.lit(1)).alias("total"))
    return fm.orderBy(id_col).limit(limit).crossJoin(F.broadcast(total))


def append_scored(existing: DataFrame, new_rows: DataFrame, id_col: str = "user_id",
                  order_col: str | None = None, id_format: str = "U%05d") -> DataFrame:
    """S13 + U1: give new rows ids max(existing id) + 1, 2, ... in
    ``order_col`` order (distributed ranking) and union them by name.

    Text ids are numbered by the digits they end in and written by
    ``id_format``; ids without digits count as 0.
    """
    order_col = order_col or id_col
    text = existing.schema[id_col].dataType.typeName() == "string"
    number = F.regexp_extract(id_col, r"(\d+)$", 1).try_cast("long") if text else F.col(id_col)
    top = existing.agg(F.coalesce(F.max(number), F.lit(0)).alias("_max"))
    ranked = global_rank(new_rows, order_col, None, rank_col="_r").crossJoin(F.broadcast(top))
    new_id = (F.col("_max") + F.col("_r")).cast("long")
    fresh = ranked.withColumn(id_col, F.format_string(id_format, new_id) if text else new_id)
    return existing.unionByName(fresh.drop("_r", "_max"))
