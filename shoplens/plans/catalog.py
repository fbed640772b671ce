"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over the
driver's tables (through ``adapters``), covering the operator inventory.
Column names equal those of the oracle SQL in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.operators import business as BZ
from shoplens.operators import clean as C
from shoplens.operators import explore as EX
from shoplens.operators import features as FE
from shoplens.operators import metrics as ME
from shoplens.operators import quality as Q
from shoplens.operators import rfm as RFM
from shoplens.operators import splits as SP
from shoplens.operators._util import materialize
from shoplens.plans import adapters as A
from shoplens.plans import oracle as O
from shoplens.schema import MEMBERSHIP_ORDER

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn

    return deco


def r6(c: str):
    """Doubles rounded to 6 places in outputs whose last bits depend on the
    engine's summation / interpolation order."""
    return F.round(F.col(c), 6).alias(c)


def urgent_buyers(spark: SparkSession, sf: str) -> DataFrame:
    o = A.orders(spark, sf, with_discount=False)
    return o.where(F.col("priority") == A.URGENT_PRIORITY).select("user_id")


# ------------------------------------------------------------------------ RFM
@register("rfm_scores")
def rfm_scores(spark: SparkSession, sf: str) -> DataFrame:
    return RFM.create_rfm_features(A.orders(spark, sf, with_discount=False))


@register("rfm_segment_summary")
def rfm_segment_summary(spark: SparkSession, sf: str) -> DataFrame:
    return RFM.segment_summary(rfm_scores(spark, sf))


# ------------------------------------------------------------------- cleaning
@register("clean_orders")
def clean_orders(spark: SparkSession, sf: str) -> DataFrame:
    o = C.clean_orders(A.orders(spark, sf))
    return o.select(
        "order_id", "user_id", r6("total_amount"), r6("log_total_amount"), "status", "status_encoded", "discount_pct"
    )


@register("clean_users")
def clean_users(spark: SparkSession, sf: str) -> DataFrame:
    u = C.clean_users(A.users(spark, sf), A.orders(spark, sf, with_discount=False), urgent_buyers(spark, sf))
    return u.select(
        "user_id", "age", "membership", "membership_encoded", "is_premium", "age_group", "account_age_days",
        "will_purchase",
    )


@register("clean_sessions")
def clean_sessions(spark: SparkSession, sf: str) -> DataFrame:
    s = C.clean_sessions(A.sessions(spark, sf))
    return s.select(
        "session_id", "user_id", r6("duration_secs_clean"), r6("pages_visited_clean"), "bounced", r6("engagement_score")
    )


@register("clean_events")
def clean_events(spark: SparkSession, sf: str) -> DataFrame:
    e = C.clean_browse_events(A.browse_events(spark, sf))
    return e.select(
        "event_id", "user_id", "product_id", "event_type", r6("time_spent_secs_clean"), "added_to_cart", "wishlisted"
    )


# ------------------------------------------------------------------- features
def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(
        *[F.round(F.col(f.name), places).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
          for f in df.schema.fields]
    )


ORDER_CUTOFF = "2001-02-01 00:00:00"


# Sessions are pinned before cleaning, which reads them in several passes
# (caps, maximum, output): they come out of the events by a window, and every
# pass would cut them anew.  SHOPLENS_STAGE_MODE=checkpoint writes them to the
# shared folder instead.  All else stays lazy, so that each query reads only
# the columns it needs.
STAGE_MODE = os.environ.get("SHOPLENS_STAGE_MODE", "persist")


def cleaned_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_sessions(materialize(A.sessions(spark, sf), STAGE_MODE))


def cleaned_events(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_browse_events(A.browse_events(spark, sf))


def cleaned_orders(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_orders(A.orders(spark, sf))


def cleaned_users(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean_users(A.users(spark, sf), A.orders(spark, sf, with_discount=False), urgent_buyers(spark, sf))


def clean_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Canonical tables through the cleaning pass, target = has an urgent order."""
    return {
        "users": cleaned_users(spark, sf),
        "products": A.products(spark, sf),
        "sessions": cleaned_sessions(spark, sf),
        "browse_events": cleaned_events(spark, sf),
        "orders": cleaned_orders(spark, sf),
        "order_items": A.order_items(spark, sf),
    }


@register("session_features")
def session_features(spark: SparkSession, sf: str) -> DataFrame:
    snap = FE.default_snapshot(A.orders(spark, sf, with_discount=False))
    return FE.create_session_features(cleaned_sessions(spark, sf), snap)


@register("browse_features")
def browse_features(spark: SparkSession, sf: str) -> DataFrame:
    return FE.create_browse_features(cleaned_events(spark, sf), A.products(spark, sf))


@register("order_features")
def order_features(spark: SparkSession, sf: str) -> DataFrame:
    o = A.orders(spark, sf)
    return FE.create_order_features(o, FE.default_snapshot(o))


@register("order_features_cutoff")
def order_features_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    o = A.orders(spark, sf)
    return FE.create_order_features(o, None, cutoff=ORDER_CUTOFF)


def feature_matrix_df(spark: SparkSession, sf: str) -> DataFrame:
    """The lazy matrix: a query that reads five columns computes five."""
    return FE.engineer_features(clean_tables(spark, sf))


@register("feature_matrix")
def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return feature_matrix_df(spark, sf)


# --------------------------------------------------------------- data quality
FINDING_COLS = ["table", "column", "level", "value"]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@register("dq_missing")
def dq_missing(spark: SparkSession, sf: str) -> DataFrame:
    t = A.canonical_tables(spark, sf)
    return _union([Q.check_missing_values(df, 0.5, name) for name, df in t.items()]).select(*FINDING_COLS)


@register("dq_duplicates")
def dq_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    t = A.canonical_tables(spark, sf)
    return _union([Q.check_duplicates(t[name], keys.split(","), name) for name, keys in O.DUP_CHECKS]).select(
        *FINDING_COLS
    )


@register("dq_ranges")
def dq_ranges(spark: SparkSession, sf: str) -> DataFrame:
    t = A.canonical_tables(spark, sf)
    return _union([Q.check_value_ranges(t[name], {c: (lo, hi)}, name) for name, c, lo, hi in O.RANGE_CHECKS]).select(
        *FINDING_COLS
    )


@register("dq_freshness")
def dq_freshness(spark: SparkSession, sf: str) -> DataFrame:
    t = A.canonical_tables(spark, sf)
    return _union([Q.check_data_freshness(t[name], c, 7, O.FRESH_REF, name) for name, c in O.FRESH_CHECKS]).select(
        *FINDING_COLS
    )


@register("dq_orphans")
def dq_orphans(spark: SparkSession, sf: str) -> DataFrame:
    t = A.canonical_tables(spark, sf)
    parts = [Q.check_referential_integrity(t[c], t[p], fk, pk, c, p) for c, fk, p, pk in O.FK_CHECKS]
    return _union(parts).select(*FINDING_COLS, "detail")


@register("dq_types")
def dq_types(spark: SparkSession, sf: str) -> DataFrame:
    t = A.canonical_tables(spark, sf)
    return _union([Q.check_data_types(t[name], m, name) for name, m in O.TYPE_CHECKS.items()]).select(
        *FINDING_COLS, "detail"
    )


@register("dq_report")
def dq_report(spark: SparkSession, sf: str) -> DataFrame:
    r = Q.generate_quality_report(A.orders(spark, sf), "orders")
    return r.withColumn(
        "value", F.when(F.col("metric").isin("mean", "std"), F.round("value", 6)).otherwise(F.col("value"))
    )


# ---------------------------------------------------------------- exploration


def users_clean(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned_users(spark, sf)


@register("dist_membership")
def dist_membership(spark, sf):
    return EX.distribution(A.users(spark, sf), "membership", MEMBERSHIP_ORDER)


@register("rate_by_membership")
def rate_by_membership(spark, sf):
    return EX.group_rate(users_clean(spark, sf), "membership", "will_purchase", "purchase_rate")


@register("sessions_per_month")
def sessions_per_month(spark, sf):
    return EX.count_by_month(A.sessions(spark, sf), "session_start")


@register("events_by_hour")
def events_by_hour(spark, sf):
    return EX.count_by_hour(A.browse_events(spark, sf), "event_ts")


@register("histogram_order_value")
def histogram_order_value(spark, sf):
    return EX.histogram(A.orders(spark, sf, with_discount=False), "total_amount", 40)


@register("events_by_category")
def events_by_category(spark, sf):
    return EX.count_by_dimension(A.browse_events(spark, sf), A.products(spark, sf), "product_id", "category")


@register("table_profile")
def table_profile(spark, sf):
    return EX.table_profile(A.canonical_tables(spark, sf))


@register("kpis")
def kpis(spark, sf):
    return EX.kpis(A.users(spark, sf), A.orders(spark, sf, with_discount=False), A.products(spark, sf),
                   A.browse_events(spark, sf))


@register("customer_stats")
def customer_stats(spark, sf):
    return EX.customer_stats(feature_matrix_df(spark, sf))


@register("target_balance")
def target_balance(spark, sf):
    return EX.target_balance(users_clean(spark, sf), "will_purchase")


@register("target_correlation")
def target_correlation(spark, sf):
    c = EX.target_correlation(feature_matrix_df(spark, sf), "will_purchase")
    return c.withColumn("abs_corr", F.round("abs_corr", 6))


@register("top_products")
def top_products(spark, sf):
    return EX.top_products(A.browse_events(spark, sf), A.products(spark, sf), 10)


# ------------------------------------------------------------ splits, weights
def split_base(spark, sf):
    return users_clean(spark, sf).select("user_id", "will_purchase", "account_age_days")


@register("stratified_split")
def stratified_split(spark, sf):
    return SP.stratified_split(split_base(spark, sf), "will_purchase", 0.2, 42).select(
        "user_id", "will_purchase", "split")


@register("temporal_split")
def temporal_split(spark, sf):
    return SP.temporal_split(split_base(spark, sf), "will_purchase", None, 0.2).select(
        "user_id", "will_purchase", "split")


@register("kfold_counts")
def kfold_counts(spark, sf):
    f = SP.kfold_assign(split_base(spark, sf), "will_purchase", 5, 42)
    return f.groupBy("fold", "will_purchase").agg(F.count(F.lit(1)).alias("n"))


@register("class_weights")
def class_weights(spark, sf):
    return SP.class_weights(split_base(spark, sf), "will_purchase")


# ---------------------------------------------------------------- evaluation
def scored_events(spark, sf):
    """y = the event is a cart add (purchase event), score = value / 500."""
    e = A.browse_events(spark, sf)
    score = F.col("time_spent_secs") / F.lit(500.0)
    return e.select(
        "event_id",
        (F.col("event_type") == "add_to_cart").cast("int").alias("y_true"),
        score.alias("y_score"),
        (score >= 0.5).cast("int").alias("y_pred"),
    )


@register("confusion")
def confusion(spark, sf):
    return ME.confusion(scored_events(spark, sf))


@register("binary_metrics")
def binary_metrics(spark, sf):
    return ME.binary_metrics(scored_events(spark, sf))


@register("roc_auc")
def roc_auc(spark, sf):
    return ME.roc_auc(scored_events(spark, sf))


@register("average_precision")
def average_precision(spark, sf):
    return ME.average_precision(scored_events(spark, sf))


@register("class_report")
def class_report(spark, sf):
    return ME.class_report(scored_events(spark, sf))


@register("roc_points")
def roc_points(spark, sf):
    return ME.roc_points(scored_events(spark, sf))


def lift_df(spark, sf):
    return ME.lift_table(scored_events(spark, sf), "event_id")


@register("lift_table")
def lift_table(spark, sf):
    return lift_df(spark, sf).select("event_id", "rank", "pct_targeted", "pct_captured", "lift")


@register("lift_summary")
def lift_summary(spark, sf):
    return ME.lift_summary(lift_df(spark, sf))


@register("best_threshold")
def best_threshold(spark, sf):
    return ME.best_threshold(scored_events(spark, sf))


@register("campaign_roi")
def campaign_roi(spark, sf):
    return BZ.campaign_table(lift_df(spark, sf))


@register("roi_curve")
def roi_curve(spark, sf):
    return BZ.roi_curve(lift_df(spark, sf))


# ------------------------------------------------------------ business rules
def base_probability(spark, sf):
    """A data-derived stand-in probability for the rule operators: the
    user's mean session engagement (0..1) from the feature matrix."""
    fm = feature_matrix_df(spark, sf)
    return fm.withColumn("probability", F.col("engagement_score_mean"))


@register("score_decay")
def score_decay(spark, sf):
    d = BZ.apply_decay(base_probability(spark, sf))
    return d.select("user_id", "probability", "adjusted_probability", "prediction")


@register("risk_tiers")
def risk_tiers(spark, sf):
    d = BZ.apply_decay(base_probability(spark, sf))
    p = F.col("adjusted_probability")
    return d.select("user_id", BZ.risk_tier(p).alias("risk"), BZ.recommended_action(p).alias("action"))


@register("driver_scores")
def driver_scores(spark, sf):
    return BZ.driver_scores(feature_matrix_df(spark, sf))


@register("top_buyers")
def top_buyers(spark, sf):
    return BZ.top_buyers(base_probability(spark, sf), "probability", 20)


@register("customer_listing")
def customer_listing(spark, sf):
    fm = feature_matrix_df(spark, sf).select("user_id", "age", "total_orders", "total_spend", "will_purchase")
    return BZ.customer_listing(fm, 100)


@register("append_customers")
def append_customers(spark, sf):
    """Existing = users with an urgent order; new = the others, appended with
    fresh ids after the current maximum, in their original id order."""
    u = users_clean(spark, sf).select("user_id", "age", "will_purchase")
    existing = u.where(F.col("will_purchase") == 1).withColumn("source", F.lit("existing"))
    new = u.where(F.col("will_purchase") == 0).withColumn("source", F.lit("new"))
    new = new.withColumn("orig_id", F.col("user_id"))
    existing = existing.withColumn("orig_id", F.col("user_id"))
    return BZ.append_scored(existing, new.drop("user_id"), order_col="orig_id")


@register("append_retried")
def append_retried(spark, sf):
    """Existing customers, then the new ones by mobile and by other devices as two
    runs; the first is sent twice, the second fails once before it is published."""
    from shoplens.session import checkpoint_dir
    from shoplens.sources import appends as AP

    path = f"{checkpoint_dir(spark).rstrip('/')}/customers-{uuid.uuid4().hex[:12]}"
    u = users_clean(spark, sf).select("user_id", "age", "device_type", "will_purchase", F.col("user_id").alias("orig_id"))
    new = u.where(F.col("will_purchase") == 0)
    mobile, others = (new.where(F.col("device_type").eqNullSafe("mobile") == F.lit(b)) for b in (True, False))
    AP.append_once(u.where(F.col("will_purchase") == 1), path, "base")
    AP.append_once(mobile, path, "mobile", order_col="orig_id")
    AP.append_once(mobile, path, "mobile", order_col="orig_id")
    AP.stage(others, path, "user_id", order_col="orig_id")
    AP.append_once(others, path, "others", order_col="orig_id")
    return AP.read_appended(spark, path)


# ----------------------------------------------------------------------- ML
def _ml_data(spark, sf):
    from shoplens.ml import train as ML

    fm = feature_matrix_df(spark, sf)
    train, test = ML.prepare(fm, "will_purchase")
    feats = ML.feature_columns(train)
    return ML, ML.sized(train), ML.sized(test), feats


@register("lr_scores")
def lr_scores(spark, sf):
    ML, train, test, feats = _ml_data(spark, sf)
    n = train.count()
    model = ML.logistic_regression(feats, "will_purchase", n, C=1.0).fit(train)
    return ML.score(model, test, "will_purchase")


@register("forest_scores")
def forest_scores(spark, sf):
    ML, train, test, feats = _ml_data(spark, sf)
    model = ML.random_forest(feats, "will_purchase").fit(train)
    return ML.score(model, test, "will_purchase")


@register("gbt_scores")
def gbt_scores(spark, sf):
    ML, train, test, feats = _ml_data(spark, sf)
    model = ML.gradient_boosting(feats, "will_purchase").fit(train)
    return ML.score(model, test, "will_purchase")


@register("overfit_report")
def overfit_report(spark, sf):
    ML, train, test, feats = _ml_data(spark, sf)
    ests = ML.baseline_estimators(feats, "will_purchase", train.count())
    _, results = ML.train_all(train, test, ests, "will_purchase")
    return ML.overfit_report(results)


def rate_models() -> dict:
    """Baselines that SQL can state in full, for the reports on models."""
    from shoplens.ml.rates import RateEstimator

    return {name: RateEstimator(c, "will_purchase") for name, c in O.RATE_COLUMNS.items()}


def rate_base(spark, sf):
    u = users_clean(spark, sf)
    return u.select("user_id", "membership", "device_type", "age_group", "will_purchase")


def _rate_results(spark, sf):
    from shoplens.ml import train as ML

    split = SP.stratified_split(rate_base(spark, sf), "will_purchase", 0.2, 42)
    part = lambda name: split.where(F.col("split") == name).drop("split")
    return ML, ML.train_all(part("train"), part("test"), rate_models(), "will_purchase")[1]


@register("leaderboard")
def leaderboard(spark, sf):
    ML, results = _rate_results(spark, sf)
    return ML.leaderboard(results)


@register("overfit_rates")
def overfit_rates(spark, sf):
    ML, results = _rate_results(spark, sf)
    return round_doubles(ML.overfit_report(results, 0.02))


@register("cv_report")
def cv_report(spark, sf):
    from shoplens.ml import train as ML

    return round_doubles(ML.cross_validate_all(rate_base(spark, sf), rate_models(), "will_purchase"))


@register("learning_curve")
def learning_curve(spark, sf):
    from shoplens.ml import train as ML

    return round_doubles(ML.learning_curve(rate_base(spark, sf), rate_models()["rate_all"], "will_purchase"))


SEARCH_SPACE = {"columns": list(O.RATE_COLUMNS), "prior": [1.0, 5.0, 20.0, 100.0, 400.0]}


@register("search_table")
def search_table(spark, sf):
    """Six drawn points of a grid of rate models on five folds each."""
    from shoplens.ml.rates import RateEstimator
    from shoplens.ml.search import search_table as search

    fit = lambda point, train: RateEstimator(O.RATE_COLUMNS[point["columns"]], "will_purchase", point["prior"]).fit(train)
    points, rows = search(rate_base(spark, sf), SEARCH_SPACE, fit, "will_purchase", n_iter=6)
    named = spark.createDataFrame([(k, p["columns"], p["prior"]) for k, p in points.items()], "point int, columns string, prior double")
    return round_doubles(rows.join(named, "point"))


@register("importances")
def importances(spark, sf):
    ML, train, test, feats = _ml_data(spark, sf)
    model = ML.gradient_boosting(feats, "will_purchase").fit(train)
    return ML.importances(model, feats)


#: How far a score, importance or gradient may lie from what it is held against.
SAME, FLAT = 1e-9, 1e-3


def _held_against(part: str, got: DataFrame, want: DataFrame, key: str, value: str, tol: float) -> DataFrame:
    """(part, name, y_true, agrees) per key of either side."""
    w = want.select(F.col(key).cast("string").alias("name"), F.col(value).alias("_want"),
                    (F.col("y_true") if "y_true" in want.columns else F.lit(None)).cast("int").alias("y_true"))
    both = got.select(F.col(key).cast("string").alias("name"), F.col(value).alias("_got")).join(w, "name", "full")
    agrees = F.coalesce(F.abs(F.col("_got") - F.col("_want")) <= tol, F.lit(False))
    return both.select(F.lit(part).alias("part"), "name", "y_true", agrees.alias("agrees"))


def _tree_checks(ML, model, test, feats) -> list[DataFrame]:
    from shoplens.ml import tables as MT

    trees = MT.tree_table(model, feats)
    return [_held_against("score", MT.tree_scores(test, trees), ML.score(model, test, "will_purchase"), "user_id", "y_score", SAME),
            _held_against("importance", MT.tree_importances(trees), ML.importances(model, feats), "feature", "importance", SAME)]


@register("forest_table")
def forest_table(spark, sf):
    """The forest's table of nodes walked for every test user and summed for
    every feature, held against the library; and where the logistic fit ended."""
    from shoplens.ml import tables as MT

    ML, train, test, feats = _ml_data(spark, sf)
    lr = ML.logistic_regression(feats, "will_purchase", train.count(), C=1.0).fit(train)
    slope = MT.logistic_gradient(lr, train, feats, "will_purchase")
    flat = _held_against("gradient", slope, slope.withColumn("gradient", F.lit(0.0)), "feature", "gradient", FLAT)
    model = ML.random_forest(feats, "will_purchase").fit(train)
    return reduce(DataFrame.unionByName, [*_tree_checks(ML, model, test, feats), flat])


@register("boosted_table")
def boosted_table(spark, sf):
    """The same for boosting at full size."""
    ML, train, test, feats = _ml_data(spark, sf)
    model = ML.gradient_boosting(feats, "will_purchase").fit(train)
    return reduce(DataFrame.unionByName, _tree_checks(ML, model, test, feats))


# ------------------------------------------------------- imputation / dedup
def sparse_user_frame(spark, sf):
    """Users left-joined to their session statistics: users without sessions
    get nulls -- the gaps the imputer fills."""
    s = A.sessions(spark, sf).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.max("pages_visited").cast("double").alias("max_pages"),
    )
    u = A.users(spark, sf).select("user_id", "age", "membership", "device_type")
    seg = A.browse_events(spark, sf).groupBy("user_id").agg(F.max("event_type").alias("top_event"))
    return u.join(s, "user_id", "left").join(seg, "user_id", "left")


@register("impute_missing")
def impute_missing(spark, sf):
    df = sparse_user_frame(spark, sf)
    return C.handle_missing_values(df, "median")


@register("dedup_keep_first")
def dedup_keep_first(spark, sf):
    e = A.browse_events(spark, sf).select("user_id", "event_id", "product_id", "event_type", "event_ts")
    return C.remove_duplicates(e, "user_id", ["event_ts", "event_id"]).select(
        "user_id", "event_id", "product_id", "event_type")


@register("temporal_features")
def temporal_features(spark, sf):
    """A6 over raw users / sessions / orders and cleaned browse events."""
    return FE.create_temporal_features(
        A.users(spark, sf), A.sessions(spark, sf), cleaned_events(spark, sf), A.orders(spark, sf),
        A.products(spark, sf), prediction_window_days=30,
    )


# ---------------------------------------------------------------- streaming
@register("stream_scores")
def stream_scores(spark, sf):
    """The customers as incoming files, scored by a stream that is stopped once
    and resumed from its checkpoint."""
    from shoplens.session import checkpoint_dir
    from shoplens.streaming.scoring import replay_files, score_resumed

    base = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex[:12]}"
    users = rate_base(spark, sf)
    model = rate_models()["rate_all"].fit(users).pinned()
    facts = feature_matrix_df(spark, sf).select("user_id", "total_orders", "days_since_last_order")
    rows = users.drop("will_purchase").join(facts, "user_id").repartition(32, "user_id")
    replay_files(rows, f"{base}/in")
    scored = score_resumed(spark, model, [], rows.schema, f"{base}/in", f"{base}/out", f"{base}/progress", files_per_batch=16)
    return scored.select("user_id", r6("probability"), r6("adjusted_probability"), "prediction")


# ------------------------------------------------------------------ sources
@register("csv_round_trip")
def csv_round_trip(spark, sf):
    """The orders written as CSV, columns out of order and every tenth total
    spoilt, and read back: good rows typed, the others with their reason."""
    from shoplens.session import checkpoint_dir
    from shoplens.sources.files import read_csv

    base = f"{checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex[:12]}"
    total = F.when(F.col("order_id") % 10 == 0, F.lit("cheap")).otherwise(F.col("total_amount").cast("string"))
    A.orders(spark, sf).select(total.alias("total_amount"), "discount_pct", "status", F.lit("x").alias("note"), "payment_method", "user_id",
                               "order_id", F.col("order_date").cast("date")).write.option("header", True).csv(f"{base}/orders.csv")
    good = read_csv(spark, f"{base}/orders.csv", "orders", rejects=f"{base}/rejects")
    bad = spark.read.schema("file string, row string, reason string").parquet(f"{base}/rejects")
    good = good.withColumn("order_date", F.col("order_date").cast("date").cast("string"))
    return good.unionByName(bad.select(F.col("row").alias("rejected_row"), "reason"), allowMissingColumns=True)
