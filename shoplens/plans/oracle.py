"""Oracle SQL (DuckDB dialect) for every registered query.

The driver registers its parquet tables as views; the canonical shop tables
are spelled here as CTEs with the same derivations as ``adapters``.  Each
oracle query is built from the CTEs it needs plus a final SELECT.
"""

from __future__ import annotations

# name -> (sql, dependencies); insertion order is a valid topological order.
CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, sql: str, deps: list[str] | None = None) -> None:
    CTES[name] = (sql.strip(), deps or [])


def build(body: str, *needed: str) -> str:
    """``WITH`` clause holding ``needed`` CTEs and their dependencies."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    if not order:
        return body.strip()
    parts = [f"{n} AS (\n{CTES[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


# ------------------------------------------------------------ canonical tables
cte(
    "shop_users",
    """
SELECT c.c_custkey AS user_id, c.c_name AS name,
       'user' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS email,
       CAST(18 + c.c_custkey % 53 AS INTEGER) AS age,
       CASE c.c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS gender,
       CAST(NULL AS VARCHAR) AS city,
       CAST(c.c_nationkey AS VARCHAR) AS state,
       CASE c.c_nationkey % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'tablet' ELSE 'desktop' END AS device_type,
       CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'free' WHEN 'MACHINERY' THEN 'free'
            WHEN 'BUILDING' THEN 'silver' WHEN 'FURNITURE' THEN 'gold'
            WHEN 'HOUSEHOLD' THEN 'platinum' END AS membership,
       CAST(COALESCE(f.first_order, TIMESTAMP '2001-08-01') AS DATE)
         - CAST(c.c_custkey % 400 AS INTEGER) AS signup_date
FROM customer c
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey) f
  ON c.c_custkey = f.o_custkey
""",
)
cte(
    "shop_orders",
    """
SELECT o.o_orderkey AS order_id, o.o_custkey AS user_id, o.o_orderdate AS order_date,
       o.o_totalprice AS total_amount,
       CASE o.o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'processing'
            WHEN 'P' THEN 'shipped' END AS status,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'debit_card'
            WHEN '3-MEDIUM' THEN 'paypal' WHEN '4-NOT SPECIFIED' THEN 'upi'
            WHEN '5-LOW' THEN 'wallet' END AS payment_method,
       o.o_orderpriority AS priority,
       COALESCE(d.disc, 0) AS discount_pct
FROM orders o
LEFT JOIN (SELECT l_orderkey,
                  CAST(floor(sum(round(l_discount * 100)) / count(*)) AS INTEGER) AS disc
           FROM lineitem GROUP BY l_orderkey) d
  ON o.o_orderkey = d.l_orderkey
""",
)
cte(
    "shop_items",
    """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_item_id,
       l_orderkey AS order_id, l_partkey AS product_id,
       CAST(trunc(l_quantity) AS INTEGER) AS quantity,
       round(l_extendedprice / NULLIF(l_quantity, 0), 2) AS unit_price
FROM lineitem
""",
)
cte(
    "shop_products",
    """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
       p_brand AS subcategory, p_retailprice AS price, p_size AS stock_qty
FROM part
""",
)
cte(
    "shop_events",
    """
SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
       CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'click'
            WHEN 'purchase' THEN 'add_to_cart' WHEN 'signup' THEN 'add_to_wishlist'
            WHEN 'error' THEN 'remove_from_cart' END AS event_type,
       value AS time_spent_secs,
       ts - INTERVAL 8232 DAY AS event_ts
FROM events
""",
)
cte(
    "ev_gap",
    """
SELECT user_id, event_id, epoch_us(event_ts) AS us,
       CASE WHEN lag(event_id) OVER w IS NULL
              OR epoch_us(event_ts) - lag(epoch_us(event_ts)) OVER w >= 21600000000
            THEN 1 ELSE 0 END AS is_start
FROM shop_events
WINDOW w AS (PARTITION BY user_id ORDER BY event_ts, event_id)
""",
    ["shop_events"],
)
cte(
    "ev_sno",
    """
SELECT *, sum(is_start) OVER (PARTITION BY user_id ORDER BY us, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sno
FROM ev_gap
""",
    ["ev_gap"],
)
cte(
    "shop_sessions",
    """
SELECT min(event_id) AS session_id, user_id,
       make_timestamp(min(us)) AS session_start, make_timestamp(max(us)) AS session_end,
       (max(us) - min(us)) // 1000000 AS duration_secs,
       CAST(count(*) AS INTEGER) AS pages_visited, count(*) = 1 AS bounced
FROM ev_sno GROUP BY user_id, sno
""",
    ["ev_sno"],
)
cte(
    "urgent_buyers",
    "SELECT DISTINCT user_id FROM shop_orders WHERE priority = '1-URGENT'",
    ["shop_orders"],
)


def floor_days(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"


def xsum(x: str, filt: str = "") -> str:
    """Sum as double by a decimal and what it leaves -- mirrors ``exact_sum``."""
    return f"(CAST(sum(CAST({x} AS DECIMAL(38,6))){filt} AS DOUBLE) + sum({x} - CAST(CAST({x} AS DECIMAL(38,6)) AS DOUBLE)){filt})"


def xavg(x: str, filt: str = "") -> str:
    """Mean with a decimal numerator -- mirrors ``exact_avg``."""
    return f"({xsum(x, filt)} / CAST(count({x}){filt} AS DOUBLE))"


QUERIES: dict[str, str] = {}


def query(name: str, body: str, *needed: str) -> None:
    QUERIES[name] = build(body, *needed)


# ------------------------------------------------------------------------ RFM
cte(
    "rfm_base",
    f"""
SELECT user_id,
       {floor_days("(SELECT max(order_date) FROM shop_orders) + INTERVAL 1 DAY", "max(order_date)")} AS recency,
       count(order_id) AS frequency,
       {xsum("total_amount")} AS monetary
FROM shop_orders GROUP BY user_id
""",
    ["shop_orders"],
)
cte(
    "rfm_scores",
    """
SELECT user_id, recency, frequency, monetary,
       CAST(5 - (1 + (recency > e.r[1])::INT + (recency > e.r[2])::INT + (recency > e.r[3])::INT) AS INTEGER) AS R_score,
       CAST(1 + (frank > 1 + (e.n - 1) * 0.25)::INT + (frank > 1 + (e.n - 1) * 0.5)::INT
              + (frank > 1 + (e.n - 1) * 0.75)::INT AS INTEGER) AS F_score,
       CAST(1 + (monetary > e.m[1])::INT + (monetary > e.m[2])::INT + (monetary > e.m[3])::INT AS INTEGER) AS M_score
FROM (SELECT b.*, row_number() OVER (ORDER BY frequency, user_id) AS frank FROM rfm_base b) ranked,
     (SELECT quantile_cont(recency, [0.25, 0.5, 0.75]) AS r,
             quantile_cont(monetary, [0.25, 0.5, 0.75]) AS m, count(*) AS n FROM rfm_base) e
""",
    ["rfm_base"],
)
cte(
    "rfm",
    """
SELECT *, R_score + F_score + M_score AS RFM_score,
       CASE WHEN R_score + F_score + M_score >= 10 THEN 'Champions'
            WHEN R_score >= 3 AND F_score >= 3 THEN 'Loyal'
            WHEN R_score >= 3 THEN 'Recent'
            WHEN F_score >= 3 THEN 'At Risk'
            WHEN R_score + F_score + M_score <= 5 THEN 'Lost'
            ELSE 'Potential' END AS segment
FROM rfm_scores
""",
    ["rfm_scores"],
)
query("rfm_scores", "SELECT * FROM rfm", "rfm")
query(
    "rfm_segment_summary",
    """
SELECT segment, count(user_id) AS count, round(avg(monetary), 1) AS avg_spend,
       round(avg(frequency), 1) AS avg_orders, round(avg(recency), 1) AS avg_recency
FROM rfm GROUP BY segment ORDER BY avg_spend DESC, segment
""",
    "rfm",
)


def clip(col: str, cap: str) -> str:
    return f"CASE WHEN {col} > {cap} THEN {cap} ELSE {col} END"


# ------------------------------------------------------------------- cleaning
cte(
    "clean_ord",
    f"""
SELECT o.*, {clip("o.total_amount_raw", "q.cap")} AS total_amount,
       ln(1 + {clip("o.total_amount_raw", "q.cap")}) AS log_total_amount,
       CASE o.status WHEN 'cancelled' THEN 0 WHEN 'returned' THEN 1 WHEN 'processing' THEN 2
            WHEN 'shipped' THEN 3 WHEN 'delivered' THEN 4 END AS status_encoded
FROM (SELECT * RENAME (total_amount AS total_amount_raw) FROM shop_orders) o,
     (SELECT quantile_cont(total_amount, 0.95) AS cap FROM shop_orders) q
""",
    ["shop_orders"],
)
cte(
    "clean_usr",
    f"""
SELECT u.*,
       CASE u.membership WHEN 'free' THEN 0 WHEN 'silver' THEN 1 WHEN 'gold' THEN 2
            WHEN 'platinum' THEN 3 END AS membership_encoded,
       CAST(u.membership IN ('gold', 'platinum') AS INTEGER) AS is_premium,
       CASE WHEN u.age > 17 AND u.age <= 25 THEN '18-25' WHEN u.age > 25 AND u.age <= 35 THEN '26-35'
            WHEN u.age > 35 AND u.age <= 50 THEN '36-50' WHEN u.age > 50 AND u.age <= 71 THEN '51+'
       END AS age_group,
       greatest({floor_days("r.ref", "CAST(u.signup_date AS TIMESTAMP)")}, 0) AS account_age_days,
       CASE WHEN b.user_id IS NULL THEN 0 ELSE 1 END AS will_purchase
FROM shop_users u
CROSS JOIN (SELECT max(order_date) AS ref FROM shop_orders) r
LEFT JOIN urgent_buyers b ON u.user_id = b.user_id
""",
    ["shop_users", "shop_orders", "urgent_buyers"],
)
cte(
    "clean_sess0",
    f"""
SELECT s.session_id, s.user_id, s.session_start, s.session_end,
       {clip("s.duration_secs", "q.qd")} AS duration_secs_clean,
       {clip("s.pages_visited", "q.qp")} AS pages_visited_clean,
       CAST(s.bounced AS INTEGER) AS bounced
FROM shop_sessions s,
     (SELECT quantile_cont(duration_secs, 0.95) AS qd, quantile_cont(pages_visited, 0.99) AS qp
      FROM shop_sessions) q
""",
    ["shop_sessions"],
)
cte(
    "clean_sess",
    """
SELECT *, round(pages_visited_clean / max(pages_visited_clean) OVER () * 0.5
                + (1 - bounced) * 0.5, 4) AS engagement_score
FROM clean_sess0
""",
    ["clean_sess0"],
)
cte(
    "clean_ev",
    f"""
SELECT e.event_id, e.user_id, e.product_id, e.event_type, e.event_ts,
       {clip("e.time_spent_secs", "q.q")} AS time_spent_secs_clean,
       CAST(e.event_type = 'add_to_cart' AS INTEGER) AS added_to_cart,
       CAST(e.event_type = 'add_to_wishlist' AS INTEGER) AS wishlisted
FROM shop_events e, (SELECT quantile_cont(time_spent_secs, 0.95) AS q FROM shop_events) q
""",
    ["shop_events"],
)
query(
    "clean_orders",
    """
SELECT order_id, user_id, round(total_amount, 6) AS total_amount,
       round(log_total_amount, 6) AS log_total_amount, status, status_encoded, discount_pct
FROM clean_ord
""",
    "clean_ord",
)
query(
    "clean_users",
    """
SELECT user_id, age, membership, membership_encoded, is_premium, age_group, account_age_days, will_purchase
FROM clean_usr
""",
    "clean_usr",
)
query(
    "clean_sessions",
    """
SELECT session_id, user_id, round(duration_secs_clean, 6) AS duration_secs_clean,
       round(pages_visited_clean, 6) AS pages_visited_clean, bounced,
       round(engagement_score, 6) AS engagement_score
FROM clean_sess
""",
    "clean_sess",
)
query(
    "clean_events",
    """
SELECT event_id, user_id, product_id, event_type, round(time_spent_secs_clean, 6) AS time_spent_secs_clean,
       added_to_cart, wishlisted
FROM clean_ev
""",
    "clean_ev",
)

# ------------------------------------------------------------------- features
SNAP = "(SELECT max(order_date) FROM shop_orders)"
cte(
    "sess_f",
    f"""
SELECT user_id,
       {xavg("duration_secs_clean")} AS duration_secs_clean_mean, max(duration_secs_clean) AS duration_secs_clean_max,
       {xsum("duration_secs_clean")} AS duration_secs_clean_sum,
       {xavg("pages_visited_clean")} AS pages_visited_clean_mean, max(pages_visited_clean) AS pages_visited_clean_max,
       {xsum("pages_visited_clean")} AS pages_visited_clean_sum,
       {xavg("engagement_score")} AS engagement_score_mean, max(engagement_score) AS engagement_score_max,
       {xsum("engagement_score")} AS engagement_score_sum,
       {xavg("bounced")} AS bounced_mean, max(bounced) AS bounced_max, CAST(sum(bounced) AS BIGINT) AS bounced_sum,
       count(session_id) AS total_sessions,
       {floor_days(SNAP, "max(session_start)")} AS days_since_last_session
FROM clean_sess GROUP BY user_id
""",
    ["clean_sess", "shop_orders"],
)
cte(
    "browse_f",
    f"""
SELECT e.user_id, count(e.event_id) AS total_events, count(DISTINCT e.product_id) AS unique_products_browsed,
       {xavg("e.time_spent_secs_clean")} AS avg_time_per_event,
       CAST(sum(e.added_to_cart) AS BIGINT) AS total_cart_adds, CAST(sum(e.wishlisted) AS BIGINT) AS total_wishlists,
       COALESCE(sum(e.added_to_cart) / NULLIF(count(e.event_id), 0), 0) AS cart_add_rate,
       COALESCE(sum(e.wishlisted) / NULLIF(count(e.event_id), 0), 0) AS wishlist_rate,
       COALESCE(sum(e.added_to_cart) / NULLIF(count(e.event_id), 0), 0) AS view_to_cart_ratio,
       count(DISTINCT p.category) AS unique_categories_browsed
FROM clean_ev e LEFT JOIN shop_products p ON e.product_id = p.product_id
GROUP BY e.user_id
""",
    ["clean_ev", "shop_products"],
)


def order_feature_sql(src: str, ref: str, where: str = "TRUE", prefix: str = "",
                      disc: str = "avg_discount_pct", freq: str = "order_frequency", extra: str = "") -> str:
    return f"""
SELECT user_id, {prefix}total_orders, {prefix}total_spend, {prefix}avg_order_value, {prefix}max_order_value,
       {disc},
       {floor_days(ref, "last_d")} AS days_since_last_order,
       greatest({floor_days("last_d", "first_d")}, 1) AS customer_lifespan_days,
       least(COALESCE({prefix}total_orders / NULLIF(greatest({floor_days("last_d", "first_d")}, 1) / 30.0, 0),
                      {prefix}total_orders), 30.0) AS {freq}{extra}
FROM (SELECT user_id, count(order_id) FILTER (WHERE {where}) AS {prefix}total_orders,
             {xsum("total_amount", f" FILTER (WHERE {where})")} AS {prefix}total_spend,
             {xavg("total_amount", f" FILTER (WHERE {where})")} AS {prefix}avg_order_value,
             max(total_amount) FILTER (WHERE {where}) AS {prefix}max_order_value,
             {xavg("discount_pct", f" FILTER (WHERE {where})")} AS {disc},
             max(order_date) FILTER (WHERE {where}) AS last_d,
             min(order_date) FILTER (WHERE {where}) AS first_d,
             max(CAST(NOT ({where}) AS INTEGER)) AS future_flag
      FROM {src} GROUP BY user_id) g
"""


cte("order_f", order_feature_sql("clean_ord", SNAP), ["clean_ord", "shop_orders"])
cte(
    "fm",
    """
SELECT u.user_id, u.age, u.account_age_days, u.will_purchase, u.device_type, u.membership_encoded, u.is_premium,
       CAST(u.account_age_days < 30 AS INTEGER) AS is_new_user,
       CAST(u.account_age_days > 365 AS INTEGER) AS is_veteran_user,
       COALESCE(s.duration_secs_clean_mean, 0) AS duration_secs_clean_mean,
       COALESCE(s.duration_secs_clean_max, 0) AS duration_secs_clean_max,
       COALESCE(s.duration_secs_clean_sum, 0) AS duration_secs_clean_sum,
       COALESCE(s.pages_visited_clean_mean, 0) AS pages_visited_clean_mean,
       COALESCE(s.pages_visited_clean_max, 0) AS pages_visited_clean_max,
       COALESCE(s.pages_visited_clean_sum, 0) AS pages_visited_clean_sum,
       COALESCE(s.engagement_score_mean, 0) AS engagement_score_mean,
       COALESCE(s.engagement_score_max, 0) AS engagement_score_max,
       COALESCE(s.engagement_score_sum, 0) AS engagement_score_sum,
       COALESCE(s.bounced_mean, 0) AS bounced_mean, COALESCE(s.bounced_max, 0) AS bounced_max,
       COALESCE(s.bounced_sum, 0) AS bounced_sum, COALESCE(s.total_sessions, 0) AS total_sessions,
       COALESCE(s.days_since_last_session, 0) AS days_since_last_session,
       COALESCE(b.total_events, 0) AS total_events, COALESCE(b.unique_products_browsed, 0) AS unique_products_browsed,
       COALESCE(b.avg_time_per_event, 0) AS avg_time_per_event, COALESCE(b.total_cart_adds, 0) AS total_cart_adds,
       COALESCE(b.total_wishlists, 0) AS total_wishlists, COALESCE(b.cart_add_rate, 0) AS cart_add_rate,
       COALESCE(b.wishlist_rate, 0) AS wishlist_rate, COALESCE(b.view_to_cart_ratio, 0) AS view_to_cart_ratio,
       COALESCE(b.unique_categories_browsed, 0) AS unique_categories_browsed,
       COALESCE(o.total_orders, 0) AS total_orders, COALESCE(o.total_spend, 0) AS total_spend,
       COALESCE(o.avg_order_value, 0) AS avg_order_value, COALESCE(o.max_order_value, 0) AS max_order_value,
       COALESCE(o.avg_discount_pct, 0) AS avg_discount_pct,
       COALESCE(o.days_since_last_order, 0) AS days_since_last_order,
       COALESCE(o.customer_lifespan_days, 0) AS customer_lifespan_days,
       COALESCE(o.order_frequency, 0) AS order_frequency
FROM clean_usr u
LEFT JOIN sess_f s ON u.user_id = s.user_id
LEFT JOIN browse_f b ON u.user_id = b.user_id
LEFT JOIN order_f o ON u.user_id = o.user_id
""",
    ["clean_usr", "sess_f", "browse_f", "order_f"],
)


def rounded(src: str, cols: str, doubles: str, tail: str = "") -> str:
    """SELECT ``cols`` from ``src`` with the ``doubles`` rounded to 6 places."""
    dbl = set(doubles.split())
    sel = ", ".join(f"round({c}, 6) AS {c}" if c in dbl else c for c in cols.split())
    return f"SELECT {sel} FROM {src} {tail}"


SESS_COLS = (
    "user_id duration_secs_clean_mean duration_secs_clean_max duration_secs_clean_sum pages_visited_clean_mean "
    "pages_visited_clean_max pages_visited_clean_sum engagement_score_mean engagement_score_max "
    "engagement_score_sum bounced_mean bounced_max bounced_sum total_sessions days_since_last_session"
)
SESS_DBL = (
    "duration_secs_clean_mean duration_secs_clean_max duration_secs_clean_sum pages_visited_clean_mean "
    "pages_visited_clean_max pages_visited_clean_sum engagement_score_mean engagement_score_max "
    "engagement_score_sum bounced_mean"
)
BROWSE_COLS = (
    "user_id total_events unique_products_browsed avg_time_per_event total_cart_adds total_wishlists "
    "cart_add_rate wishlist_rate view_to_cart_ratio unique_categories_browsed"
)
BROWSE_DBL = "avg_time_per_event cart_add_rate wishlist_rate view_to_cart_ratio"
ORDER_COLS = (
    "user_id total_orders total_spend avg_order_value max_order_value avg_discount_pct days_since_last_order "
    "customer_lifespan_days order_frequency"
)
ORDER_DBL = "total_spend avg_order_value max_order_value avg_discount_pct order_frequency"
FM_COLS = (
    "user_id age account_age_days will_purchase device_type membership_encoded is_premium is_new_user "
    "is_veteran_user " + " ".join(SESS_COLS.split()[1:]) + " " + " ".join(BROWSE_COLS.split()[1:]) + " "
    + " ".join(ORDER_COLS.split()[1:])
)
FM_DBL = SESS_DBL + " " + BROWSE_DBL + " " + ORDER_DBL

query("session_features", rounded("sess_f", SESS_COLS, ""), "sess_f")
query("browse_features", rounded("browse_f", BROWSE_COLS, ""), "browse_f")
cte("order_f_raw", order_feature_sql("shop_orders", SNAP), ["shop_orders"])
query("order_features", rounded("order_f_raw", ORDER_COLS, ""), "order_f_raw")
CUTOFF = "TIMESTAMP '2001-02-01 00:00:00'"
cte(
    "order_f_cut",
    order_feature_sql("shop_orders", CUTOFF, where=f"order_date < {CUTOFF}",
                      extra=", future_flag AS will_purchase_future") + " WHERE total_orders > 0",
    ["shop_orders"],
)
query("order_features_cutoff", rounded("order_f_cut", ORDER_COLS + " will_purchase_future", ""), "order_f_cut")
query("feature_matrix", rounded("fm", FM_COLS, ""), "fm")


# ------------------------------------------------------------- data quality
TABLE_COLUMNS = {
    "users": ("shop_users", "user_id name email age gender city state device_type membership signup_date"),
    "orders": ("shop_orders", "order_id user_id order_date total_amount status payment_method priority discount_pct"),
    "sessions": ("shop_sessions", "session_id user_id session_start session_end duration_secs pages_visited bounced"),
    "browse_events": ("shop_events", "event_id user_id product_id event_type time_spent_secs event_ts"),
    "products": ("shop_products", "product_id product_name category subcategory price stock_qty"),
    "order_items": ("shop_items", "order_item_id order_id product_id quantity unit_price"),
}
_missing = []
for _t, (_src, _cols) in TABLE_COLUMNS.items():
    for _c in _cols.split():
        _missing.append(f"SELECT '{_t}' AS \"table\", '{_c}' AS \"column\", avg(CAST({_c} IS NULL AS DOUBLE)) AS share FROM {_src}")
query(
    "dq_missing",
    "SELECT \"table\", \"column\", CASE WHEN share > 0.5 THEN 'error' ELSE 'warning' END AS level, share AS value "
    "FROM (" + " UNION ALL ".join(_missing) + ") m WHERE share > 0",
    *[v[0] for v in TABLE_COLUMNS.values()],
)

DUP_CHECKS = [("orders", "user_id,order_date"), ("browse_events", "user_id,product_id,event_type"),
              ("order_items", "order_id,product_id")]
_dups = [
    f"SELECT '{t}' AS \"table\", '{k}' AS \"column\", COALESCE(CAST(sum(n - 1) AS BIGINT), 0) AS d "
    f"FROM (SELECT count(*) AS n FROM {TABLE_COLUMNS[t][0]} GROUP BY {k}) g"
    for t, k in DUP_CHECKS
]
query(
    "dq_duplicates",
    "SELECT \"table\", \"column\", CASE WHEN d > 0 THEN 'warning' ELSE 'ok' END AS level, CAST(d AS DOUBLE) AS value "
    "FROM (" + " UNION ALL ".join(_dups) + ") x",
    "shop_orders", "shop_events", "shop_items",
)

RANGE_CHECKS = [("users", "age", 18, 65), ("orders", "total_amount", 1000.0, 450000.0), ("orders", "discount_pct", 0, 8),
                ("browse_events", "time_spent_secs", 0.0, 400.0)]
_ranges = [
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS n "
    f"FROM {TABLE_COLUMNS[t][0]}"
    for t, c, lo, hi in RANGE_CHECKS
]
query(
    "dq_ranges",
    "SELECT \"table\", \"column\", CASE WHEN n > 0 THEN 'error' ELSE 'ok' END AS level, CAST(n AS DOUBLE) AS value "
    "FROM (" + " UNION ALL ".join(_ranges) + ") x",
    "shop_users", "shop_orders", "shop_events",
)

FRESH_CHECKS = [("orders", "order_date"), ("sessions", "session_start"), ("browse_events", "event_ts")]
FRESH_REF = "2001-08-15 00:00:00"
_REF_TS = f"TIMESTAMP '{FRESH_REF}'"
_fresh = [
    f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", "
    + floor_days(_REF_TS, f"max(CAST({c} AS TIMESTAMP))")
    + f" AS age FROM {TABLE_COLUMNS[t][0]}"
    for t, c in FRESH_CHECKS
]
query(
    "dq_freshness",
    "SELECT \"table\", \"column\", CASE WHEN age > 7 THEN 'warning' ELSE 'ok' END AS level, CAST(age AS DOUBLE) AS value "
    "FROM (" + " UNION ALL ".join(_fresh) + ") x",
    "shop_orders", "shop_sessions", "shop_events",
)

FK_CHECKS = [("sessions", "user_id", "users", "user_id"), ("orders", "user_id", "users", "user_id"),
             ("order_items", "order_id", "orders", "order_id"), ("browse_events", "product_id", "products", "product_id"),
             ("browse_events", "user_id", "users", "user_id")]
_fk = []
for _ct, _fkc, _pt, _pk in FK_CHECKS:
    _child, _parent = TABLE_COLUMNS[_ct][0], TABLE_COLUMNS[_pt][0]
    _orph = (f"(SELECT c.{_fkc} AS v FROM {_child} c WHERE NOT EXISTS "
             f"(SELECT 1 FROM {_parent} p WHERE p.{_pk} IS NOT DISTINCT FROM c.{_fkc}))")
    _fk.append(
        f"SELECT '{_ct}' AS \"table\", '{_fkc}' AS \"column\", (SELECT count(*) FROM {_orph} o1) AS n, "
        f"'{_ct}.{_fkc} -> {_pt}.{_pk} e.g. ' || COALESCE((SELECT string_agg(CAST(v AS VARCHAR), ',' ORDER BY CAST(v AS VARCHAR)) "
        f"FROM (SELECT DISTINCT v FROM {_orph} o2 ORDER BY v NULLS FIRST LIMIT 5) s), '') AS detail"
    )
query(
    "dq_orphans",
    "SELECT \"table\", \"column\", CASE WHEN n > 0 THEN 'error' ELSE 'ok' END AS level, CAST(n AS DOUBLE) AS value, detail "
    "FROM (" + " UNION ALL ".join(_fk) + ") x",
    *[v[0] for v in TABLE_COLUMNS.values()],
)

TYPE_CHECKS = {
    "users": {"user_id": "int", "age": "int", "signup_date": "datetime", "membership": "object"},
    "orders": {"order_id": "int", "order_date": "datetime", "total_amount": "float", "discount_pct": "int64",
               "status": "object"},
    "sessions": {"session_start": "datetime", "duration_secs": "int", "bounced": "bool"},
    "browse_events": {"product_id": "int64", "time_spent_secs": "int"},
}
_DUCK_TYPES = ("CASE t WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'DOUBLE' THEN 'float64' "
               "WHEN 'VARCHAR' THEN 'object' WHEN 'BOOLEAN' THEN 'bool' WHEN 'TIMESTAMP' THEN 'datetime64[ns]' "
               "WHEN 'DATE' THEN 'datetime64[ns]' ELSE lower(t) END")
_types = []
for _t, _m in TYPE_CHECKS.items():
    for _c, _want in _m.items():
        _types.append(
            f"SELECT '{_t}' AS \"table\", '{_c}' AS \"column\", '{_want}' AS want, "
            f"(SELECT {_DUCK_TYPES} FROM (SELECT typeof({_c}) AS t FROM {TABLE_COLUMNS[_t][0]} LIMIT 1) z) AS actual"
        )
query(
    "dq_types",
    "SELECT \"table\", \"column\", CASE WHEN contains(actual, want) THEN 'ok' ELSE 'error' END AS level, "
    "CASE WHEN contains(actual, want) THEN 0.0 ELSE 1.0 END AS value, "
    "'expected ' || want || ', got ' || actual AS detail FROM (" + " UNION ALL ".join(_types) + ") x",
    "shop_users", "shop_orders", "shop_sessions", "shop_events",
)

_ord_cols = TABLE_COLUMNS["orders"][1].split()
_ord_num = ["order_id", "user_id", "total_amount", "discount_pct"]
_ord_str = ["status", "payment_method", "priority"]
_rep = ["SELECT '*' AS \"column\", 'total_rows' AS metric, CAST(count(*) AS DOUBLE) AS value, NULL AS detail FROM shop_orders",
        f"SELECT '*', 'total_columns', {float(len(_ord_cols))}, NULL",
        "SELECT '*', 'duplicate_rows', CAST(COALESCE(sum(n - 1), 0) AS DOUBLE), NULL FROM "
        f"(SELECT count(*) AS n FROM shop_orders GROUP BY {', '.join(_ord_cols)}) g"]
for _c in _ord_cols:
    _rep.append(f"SELECT '{_c}', 'null_count', CAST(count(*) FILTER (WHERE {_c} IS NULL) AS DOUBLE), NULL FROM shop_orders")
    _rep.append(f"SELECT '{_c}', 'dtype', NULL, (SELECT {_DUCK_TYPES} FROM (SELECT typeof({_c}) AS t FROM shop_orders LIMIT 1) z)")
for _c in _ord_num:
    _rep.append(f"SELECT '{_c}', 'mean', round({xavg(f'CAST({_c} AS DOUBLE)')}, 6), NULL FROM shop_orders")
    _rep.append(f"SELECT '{_c}', 'std', round(stddev_samp(CAST({_c} AS DOUBLE)), 6), NULL FROM shop_orders")
    _rep.append(f"SELECT '{_c}', 'min', CAST(min({_c}) AS DOUBLE), NULL FROM shop_orders")
    _rep.append(f"SELECT '{_c}', 'max', CAST(max({_c}) AS DOUBLE), NULL FROM shop_orders")
for _c in _ord_str:
    _rep.append(f"SELECT '{_c}', 'unique_values', CAST(count(DISTINCT {_c}) AS DOUBLE), NULL FROM shop_orders")
    _rep.append(
        f"SELECT '{_c}', 'top' || CAST(rk AS VARCHAR), CAST(n AS DOUBLE), v FROM (SELECT {_c} AS v, count(*) AS n, "
        f"row_number() OVER (ORDER BY count(*) DESC, {_c}) AS rk FROM shop_orders WHERE {_c} IS NOT NULL GROUP BY {_c}) t "
        "WHERE rk <= 3"
    )
query("dq_report", "SELECT 'orders' AS \"table\", * FROM (" + " UNION ALL ".join(_rep) + ") r", "shop_orders")


# ---------------------------------------------------------------- exploration
query(
    "dist_membership",
    """
SELECT l.membership, CAST(COALESCE(c.n, 0) AS BIGINT) AS count,
       CAST(COALESCE(c.n, 0) AS DOUBLE) * 100.0 / CAST((SELECT count(*) FROM shop_users) AS DOUBLE) AS pct
FROM (VALUES ('free', 0), ('silver', 1), ('gold', 2), ('platinum', 3)) l(membership, o)
LEFT JOIN (SELECT membership, count(*) AS n FROM shop_users GROUP BY membership) c ON l.membership = c.membership
ORDER BY l.o
""",
    "shop_users",
)
query(
    "rate_by_membership",
    "SELECT membership, count(*) AS n, avg(CAST(will_purchase AS DOUBLE)) * 100.0 AS purchase_rate "
    "FROM clean_usr GROUP BY membership",
    "clean_usr",
)
query(
    "sessions_per_month",
    "SELECT strftime(session_start, '%Y-%m') AS month, count(*) AS count FROM shop_sessions GROUP BY 1",
    "shop_sessions",
)
query(
    "events_by_hour",
    "SELECT CAST(hour(event_ts) AS INTEGER) AS hour_of_day, count(*) AS count FROM shop_events GROUP BY 1",
    "shop_events",
)
query(
    "histogram_order_value",
    f"""
SELECT k.bin, lo + k.bin * ((hi - lo) / 40.0) AS lower, lo + (k.bin + 1) * ((hi - lo) / 40.0) AS upper,
       COALESCE(n, 0) AS count, mean
FROM (SELECT min(total_amount) AS lo, max(total_amount) AS hi, {xavg("total_amount")} AS mean FROM shop_orders) s
CROSS JOIN (SELECT CAST(unnest(range(40)) AS INTEGER) AS bin) k
LEFT JOIN (SELECT CAST(least(floor((o.total_amount - s.lo) / ((s.hi - s.lo) / 40.0)), 39) AS INTEGER) AS bin, count(*) AS n
           FROM shop_orders o, (SELECT min(total_amount) AS lo, max(total_amount) AS hi FROM shop_orders) s
           WHERE o.total_amount IS NOT NULL GROUP BY ALL) c ON c.bin = k.bin
""",
    "shop_orders",
)
query(
    "events_by_category",
    "SELECT p.category, count(*) AS count FROM shop_events e LEFT JOIN shop_products p "
    "ON e.product_id = p.product_id GROUP BY p.category",
    "shop_events", "shop_products",
)
_prof = []
for _t, (_src, _cols) in TABLE_COLUMNS.items():
    _cl = _cols.split()
    _nulls = " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in _cl)
    _prof.append(
        f"SELECT '{_t}' AS \"table\", count(*) AS rows, {len(_cl)} AS columns, {_nulls} AS null_cells, "
        f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {_src}) d) AS duplicate_rows FROM {_src}"
    )
query("table_profile", " UNION ALL ".join(_prof), *[v[0] for v in TABLE_COLUMNS.values()])
query(
    "kpis",
    """
SELECT (SELECT count(*) FROM shop_users) AS users, (SELECT count(*) FROM shop_orders) AS orders,
       (SELECT count(*) FROM shop_products) AS products, (SELECT count(*) FROM shop_events) AS events,
       CAST((SELECT count(DISTINCT user_id) FROM shop_orders) AS DOUBLE) * 100.0
         / CAST((SELECT count(*) FROM shop_users) AS DOUBLE) AS buyer_rate
""",
    "shop_users", "shop_orders", "shop_products", "shop_events",
)
query(
    "customer_stats",
    f"""
SELECT count(*) AS total_customers,
       count(*) FILTER (WHERE total_spend > (SELECT quantile_cont(total_spend, 0.5) FROM fm)) AS high_value_customers,
       {xavg("avg_order_value")} AS avg_order_value, {xsum("total_spend")} AS total_revenue,
       avg(CAST(will_purchase AS DOUBLE)) AS purchase_rate
FROM fm
""",
    "fm",
)
query(
    "target_balance",
    "SELECT CAST(sum(will_purchase) AS BIGINT) AS buyers, CAST(count(*) - sum(will_purchase) AS BIGINT) AS non_buyers, "
    "avg(CAST(will_purchase AS DOUBLE)) AS share FROM clean_usr",
    "clean_usr",
)
_FM_NUMERIC = [c for c in FM_COLS.split() if c not in ("user_id", "will_purchase", "device_type")]
_corr = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(covar_pop(CAST({c} AS DOUBLE), CAST(will_purchase AS DOUBLE)) / "
    f"NULLIF(stddev_pop(CAST({c} AS DOUBLE)) * stddev_pop(CAST(will_purchase AS DOUBLE)), 0)) AS abs_corr FROM fm"
    for c in _FM_NUMERIC
)
query(
    "target_correlation",
    f"SELECT feature, round(abs_corr, 6) AS abs_corr FROM ({_corr}) c ORDER BY abs_corr DESC NULLS LAST, feature",
    "fm",
)
query(
    "top_products",
    """
SELECT c.product_id, c.browse_count, p.product_name, p.category, p.price
FROM (SELECT product_id, count(*) AS browse_count FROM shop_events GROUP BY product_id) c
JOIN shop_products p ON c.product_id = p.product_id
ORDER BY c.browse_count DESC, c.product_id LIMIT 10
""",
    "shop_events", "shop_products",
)

# ------------------------------------------------------------ splits, weights
cte(
    "split_ranked",
    """
SELECT user_id, will_purchase, account_age_days,
       row_number() OVER (PARTITION BY will_purchase
                          ORDER BY md5('42|' || CAST(user_id AS VARCHAR)), user_id) AS class_rank,
       count(*) OVER (PARTITION BY will_purchase) AS class_n
FROM clean_usr
""",
    ["clean_usr"],
)
query(
    "stratified_split",
    "SELECT user_id, will_purchase, CASE WHEN class_rank <= round(class_n * 0.2) THEN 'test' ELSE 'train' END AS split "
    "FROM split_ranked",
    "split_ranked",
)
query(
    "temporal_split",
    """
SELECT user_id, will_purchase,
       CASE WHEN row_number() OVER (ORDER BY account_age_days, user_id) <= floor(count(*) OVER () * 0.2)
            THEN 'test' ELSE 'train' END AS split
FROM clean_usr
""",
    "clean_usr",
)
query(
    "kfold_counts",
    "SELECT CAST((class_rank - 1) % 5 AS INTEGER) AS fold, will_purchase, count(*) AS n FROM split_ranked GROUP BY 1, 2",
    "split_ranked",
)
query(
    "class_weights",
    """
SELECT will_purchase, n AS count,
       CAST(sum(n) OVER () AS DOUBLE) / CAST(count(*) OVER () * n AS DOUBLE) AS weight,
       CAST(sum(CASE WHEN will_purchase <> 1 THEN n ELSE 0 END) OVER () AS DOUBLE)
         / CAST(greatest(sum(CASE WHEN will_purchase = 1 THEN n ELSE 0 END) OVER (), 1) AS DOUBLE) AS pos_weight
FROM (SELECT will_purchase, count(*) AS n FROM clean_usr GROUP BY will_purchase) g
""",
    "clean_usr",
)

# ---------------------------------------------------------------- evaluation
cte(
    "scored",
    """
SELECT event_id, CAST(event_type = 'add_to_cart' AS INTEGER) AS y_true, time_spent_secs / 500.0 AS y_score,
       CAST(time_spent_secs / 500.0 >= 0.5 AS INTEGER) AS y_pred
FROM shop_events
""",
    ["shop_events"],
)
cte(
    "conf",
    """
SELECT count(*) FILTER (WHERE y_true <> 1 AND y_pred <> 1) AS tn, count(*) FILTER (WHERE y_true <> 1 AND y_pred = 1) AS fp,
       count(*) FILTER (WHERE y_true = 1 AND y_pred <> 1) AS fn, count(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp
FROM scored
""",
    ["scored"],
)


def ratio(a: str, b: str) -> str:
    return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"


query("confusion", "SELECT * FROM conf", "conf")
query(
    "binary_metrics",
    f"SELECT {ratio('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {ratio('tp', 'tp + fp')} AS precision, "
    f"{ratio('tp', 'tp + fn')} AS recall, {ratio('2 * tp', '2 * tp + fp + fn')} AS f1 FROM conf",
    "conf",
)
cte(
    "per_class",
    f"""
SELECT {ratio('tn', 'tn + fn')} AS p0, {ratio('tn', 'tn + fp')} AS r0, {ratio('2 * tn', '2 * tn + fn + fp')} AS f0,
       tn + fp AS s0,
       {ratio('tp', 'tp + fp')} AS p1, {ratio('tp', 'tp + fn')} AS r1, {ratio('2 * tp', '2 * tp + fp + fn')} AS f1,
       tp + fn AS s1, {ratio('tp + tn', 'tp + fp + fn + tn')} AS acc, tp + fp + fn + tn AS n
FROM conf
""",
    ["conf"],
)
query(
    "class_report",
    """
SELECT '0' AS label, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM per_class
UNION ALL SELECT '1', p1, r1, f1, s1 FROM per_class
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM per_class
UNION ALL SELECT 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n, (f0 * s0 + f1 * s1) / n, n FROM per_class
UNION ALL SELECT 'accuracy', NULL, NULL, acc, n FROM per_class
""",
    "per_class",
)
cte(
    "groups_asc",
    """
SELECT score, pos, neg,
       sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
FROM (SELECT y_score AS score, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true <> 1) AS neg
      FROM scored GROUP BY y_score) g
""",
    ["scored"],
)
cte(
    "groups_desc",
    """
SELECT score, pos, neg, row_number() OVER (ORDER BY score DESC) AS point,
       sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
       sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
FROM (SELECT y_score AS score, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true <> 1) AS neg
      FROM scored GROUP BY y_score) g
""",
    ["scored"],
)
cte("totals", "SELECT count(*) FILTER (WHERE y_true = 1) AS P, count(*) FILTER (WHERE y_true <> 1) AS N FROM scored",
    ["scored"])
query(
    "roc_auc",
    "SELECT sum(pos * (cum_neg - neg * 0.5)) / CAST((SELECT P * N FROM totals) AS DOUBLE) AS auc FROM groups_asc",
    "groups_asc", "totals",
)
query(
    "average_precision",
    "SELECT round(sum(pos * (CAST(cum_pos AS DOUBLE) / CAST(cum_pos + cum_neg AS DOUBLE))) "
    "/ CAST((SELECT P FROM totals) AS DOUBLE), 9) AS average_precision FROM groups_desc",
    "groups_desc", "totals",
)
cte(
    "roc_kept",
    """
SELECT point, score, cum_pos, cum_neg,
       lag(cum_pos) OVER w AS tp0, lead(cum_pos) OVER w AS tp2, lag(cum_neg) OVER w AS fp0, lead(cum_neg) OVER w AS fp2
FROM groups_desc WINDOW w AS (ORDER BY point)
""",
    ["groups_desc"],
)
cte(
    "roc_pts",
    """
SELECT CAST(0 AS BIGINT) AS point, CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS BIGINT) AS tps, CAST(0 AS BIGINT) AS fps
UNION ALL
SELECT row_number() OVER (ORDER BY point), score, cum_pos, cum_neg FROM roc_kept
WHERE tp0 IS NULL OR tp2 IS NULL OR fp0 - 2 * cum_neg + fp2 <> 0 OR tp0 - 2 * cum_pos + tp2 <> 0
""",
    ["roc_kept"],
)
query(
    "roc_points",
    """
WITH kept AS (
  SELECT point, score, cum_pos, cum_neg,
         lag(cum_pos) OVER w AS tp0, lead(cum_pos) OVER w AS tp2, lag(cum_neg) OVER w AS fp0, lead(cum_neg) OVER w AS fp2
  FROM groups_desc WINDOW w AS (ORDER BY point)),
pts AS (
  SELECT 0 AS point, CAST(NULL AS DOUBLE) AS threshold, 0 AS tps, 0 AS fps
  UNION ALL
  SELECT row_number() OVER (ORDER BY point), score, cum_pos, cum_neg FROM kept
  WHERE tp0 IS NULL OR tp2 IS NULL OR fp0 - 2 * cum_neg + fp2 <> 0 OR tp0 - 2 * cum_pos + tp2 <> 0)
SELECT point, threshold, CAST(fps AS DOUBLE) / CAST((SELECT N FROM totals) AS DOUBLE) AS fpr,
       CAST(tps AS DOUBLE) / CAST((SELECT P FROM totals) AS DOUBLE) AS tpr
FROM pts WHERE point % greatest(floor((SELECT count(*) FROM pts) / 100), 1) = 0
""".replace("WITH kept AS (", "kept_q AS (") if False else """
SELECT point, threshold, CAST(fps AS DOUBLE) / CAST((SELECT N FROM totals) AS DOUBLE) AS fpr,
       CAST(tps AS DOUBLE) / CAST((SELECT P FROM totals) AS DOUBLE) AS tpr
FROM roc_pts WHERE point % greatest(floor((SELECT count(*) FROM roc_pts) / 100), 1) = 0
""",
    "roc_pts", "totals",
)
cte(
    "lift",
    """
SELECT event_id, rank, cum_buyers, CAST(rank AS DOUBLE) / CAST(n AS DOUBLE) AS pct_targeted,
       CAST(cum_buyers AS DOUBLE) / CAST(P AS DOUBLE) AS pct_captured,
       (CAST(cum_buyers AS DOUBLE) / CAST(P AS DOUBLE)) / (CAST(rank AS DOUBLE) / CAST(n AS DOUBLE)) AS lift, n AS n_total
FROM (SELECT event_id, row_number() OVER (ORDER BY y_score DESC, event_id) AS rank,
             CAST(sum(y_true) OVER (ORDER BY y_score DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_buyers,
             count(*) OVER () AS n, sum(y_true) OVER () AS P
      FROM scored) r
""",
    ["scored"],
)
query("lift_table", "SELECT event_id, rank, pct_targeted, pct_captured, lift FROM lift", "lift")


def first_rows(depths: str, tol: str = "0.0") -> str:
    return (f"SELECT d.pct, l.* FROM lift l, (SELECT unnest({depths}) AS pct) d "
            f"WHERE l.pct_targeted >= d.pct - {tol} AND CAST(l.rank - 1 AS DOUBLE) / CAST(l.n_total AS DOUBLE) < d.pct - {tol}")


query("lift_summary", f"SELECT pct, pct_captured, lift FROM ({first_rows('[0.1, 0.2, 0.3, 0.4, 0.5]')}) f", "lift")
query(
    "best_threshold",
    """
SELECT score AS threshold, f1 FROM (
  SELECT score, CAST(2 * cum_pos AS DOUBLE) / CAST(cum_pos + cum_neg + (SELECT P FROM totals) AS DOUBLE) AS f1
  FROM groups_desc) x
ORDER BY f1 DESC, threshold ASC LIMIT 1
""",
    "groups_desc", "totals",
)
_CAMPAIGN = """
SELECT pct, CAST(floor(n_total * pct) AS BIGINT) AS targeted, cum_buyers AS captured, pct_captured, lift,
       cum_buyers * 50.0 * 0.15 AS revenue, CAST(floor(n_total * pct) AS BIGINT) * 0.5 AS cost,
       cum_buyers * 50.0 * 0.15 - CAST(floor(n_total * pct) AS BIGINT) * 0.5 AS profit,
       CASE WHEN CAST(floor(n_total * pct) AS BIGINT) * 0.5 > 0
            THEN (cum_buyers * 50.0 * 0.15 - CAST(floor(n_total * pct) AS BIGINT) * 0.5)
                 / (CAST(floor(n_total * pct) AS BIGINT) * 0.5) * 100 ELSE 0.0 END AS roi
FROM ({rows}) f
"""
query("campaign_roi", _CAMPAIGN.format(rows=first_rows("[0.1, 0.2, 0.3, 0.4, 0.5, 1.0]")), "lift")
_DEPTHS = "[" + ", ".join(repr(0.05 + i * 0.05) for i in range(20)) + "]"
query(
    "roi_curve",
    f"""
SELECT pct, roi, revenue, cost,
       pct = (SELECT pct FROM ({_CAMPAIGN.format(rows=first_rows(_DEPTHS, '0.001'))}) c2 ORDER BY roi DESC, pct ASC LIMIT 1)
         AS is_best
FROM ({_CAMPAIGN.format(rows=first_rows(_DEPTHS, '0.001'))}) c
""",
    "lift",
)


# ------------------------------------------------------------ business rules
def decayed(prob: str, source: str) -> str:
    """The recency decay rules on a column of ``source``."""
    return f"""
SELECT user_id, {prob} AS probability, total_orders, days_since_last_order,
       CASE WHEN total_orders = 0 AND days_since_last_order > 60 THEN p1 * 0.3 ELSE p1 END AS adjusted_probability
FROM (SELECT *, {prob} * CASE
          WHEN total_orders > 0 AND days_since_last_order > 90 AND days_since_last_order >= 180 THEN 0.25
          WHEN total_orders > 0 AND days_since_last_order > 90 AND days_since_last_order >= 150 THEN 0.35
          WHEN total_orders > 0 AND days_since_last_order > 90 AND days_since_last_order >= 120 THEN 0.5
          WHEN total_orders > 0 AND days_since_last_order > 90 THEN 0.7 ELSE 1.0 END AS p1
      FROM {source}) x
"""


cte("decay", decayed("engagement_score_mean", "fm"), ["fm"])
query(
    "score_decay",
    "SELECT user_id, probability, adjusted_probability, CAST(adjusted_probability >= 0.5 AS INTEGER) AS prediction FROM decay",
    "decay",
)
query(
    "risk_tiers",
    """
SELECT user_id,
       CASE WHEN adjusted_probability >= 0.6 THEN 'High' WHEN adjusted_probability >= 0.4 THEN 'Medium' ELSE 'Low' END AS risk,
       CASE WHEN adjusted_probability >= 0.5 THEN 'Send promo email' ELSE 'Nurture campaign' END AS action
FROM decay
""",
    "decay",
)
query(
    "driver_scores",
    """
SELECT user_id, driver, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, driver) AS rank
FROM (
  SELECT user_id, 'Cart-add rate' AS driver, CAST(cart_add_rate * 3 AS DOUBLE) AS score FROM fm
  UNION ALL SELECT user_id, 'Total sessions', least(total_sessions / 100, 1.0) FROM fm
  UNION ALL SELECT user_id, 'Engagement score', CAST(engagement_score_mean AS DOUBLE) FROM fm
  UNION ALL SELECT user_id, 'Membership tier', membership_encoded / 3 FROM fm
  UNION ALL SELECT user_id, 'Account age', least(account_age_days / 500, 1.0) FROM fm
  UNION ALL SELECT user_id, 'Unique categories', unique_categories_browsed / 6 FROM fm
  UNION ALL SELECT user_id, 'Days since last session', greatest(0.0, 1 - days_since_last_session / 180) FROM fm) d
""",
    "fm",
)
query(
    "top_buyers",
    """
SELECT user_id, probability, rank,
       CASE WHEN rank <= 5 THEN 'Priority email' WHEN rank <= 15 THEN 'Standard email' ELSE 'Push notification' END
         AS recommended_action
FROM (SELECT user_id, engagement_score_mean AS probability,
             row_number() OVER (ORDER BY engagement_score_mean DESC, user_id) AS rank FROM fm) r
WHERE rank <= 20
""",
    "fm",
)
query(
    "customer_listing",
    "SELECT user_id, age, total_orders, total_spend, will_purchase, (SELECT count(*) FROM fm) AS total "
    "FROM fm ORDER BY user_id LIMIT 100",
    "fm",
)
query(
    "append_customers",
    """
SELECT user_id, age, will_purchase, 'existing' AS source, user_id AS orig_id FROM clean_usr WHERE will_purchase = 1
UNION ALL
SELECT (SELECT COALESCE(max(user_id), 0) FROM clean_usr WHERE will_purchase = 1)
         + row_number() OVER (ORDER BY user_id) AS user_id,
       age, will_purchase, 'new' AS source, user_id AS orig_id
FROM clean_usr WHERE will_purchase = 0
""",
    "clean_usr",
)


# ------------------------------------------------------- imputation / dedup
cte(
    "sparse_users",
    """
SELECT u.user_id, u.age, u.membership, u.device_type, s.total_sessions, s.max_pages, e.top_event
FROM shop_users u
LEFT JOIN (SELECT user_id, count(*) AS total_sessions, CAST(max(pages_visited) AS DOUBLE) AS max_pages
           FROM shop_sessions GROUP BY user_id) s ON u.user_id = s.user_id
LEFT JOIN (SELECT user_id, max(event_type) AS top_event FROM shop_events GROUP BY user_id) e ON u.user_id = e.user_id
""",
    ["shop_users", "shop_sessions", "shop_events"],
)


def _mode(col: str) -> str:
    return (f"(SELECT {col} FROM sparse_users WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, {col} LIMIT 1)")


query(
    "impute_missing",
    f"""
SELECT COALESCE(user_id, CAST(trunc((SELECT quantile_cont(user_id, 0.5) FROM sparse_users)) AS BIGINT)) AS user_id,
       COALESCE(age, CAST(trunc((SELECT quantile_cont(age, 0.5) FROM sparse_users)) AS INTEGER)) AS age,
       COALESCE(membership, {_mode('membership')}) AS membership,
       COALESCE(device_type, {_mode('device_type')}) AS device_type,
       COALESCE(total_sessions, CAST(trunc((SELECT quantile_cont(total_sessions, 0.5) FROM sparse_users)) AS BIGINT))
         AS total_sessions,
       COALESCE(max_pages, (SELECT quantile_cont(max_pages, 0.5) FROM sparse_users)) AS max_pages,
       COALESCE(top_event, {_mode('top_event')}) AS top_event
FROM sparse_users
""",
    "sparse_users",
)
query(
    "dedup_keep_first",
    """
SELECT user_id, event_id, product_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_ts, event_id) AS rn
  FROM (SELECT DISTINCT user_id, event_id, product_id, event_type, event_ts FROM shop_events) d) x
WHERE rn = 1
""",
    "shop_events",
)


# ------------------------------------------------------ temporal features
cte("t6_cut", "SELECT max(order_date) - INTERVAL 30 DAY AS cut FROM shop_orders", ["shop_orders"])
cte(
    "t6_sess_past",
    """
SELECT s.* FROM shop_sessions s, t6_cut c WHERE s.session_start < c.cut
""",
    ["shop_sessions", "t6_cut"],
)
cte(
    "t6_sess",
    f"""
SELECT user_id, count(session_id) AS total_sessions,
       {xavg("dclean")} AS avg_duration, max(dclean) AS max_duration,
       {xavg("pclean")} AS avg_pages, max(pclean) AS max_pages,
       0.0 AS avg_engagement, {xavg("CAST(bounced AS INTEGER)")} AS bounce_rate,
       {floor_days("(SELECT cut FROM t6_cut)", "max(session_start)")} AS days_since_last_session
FROM (SELECT s.*, {clip("s.duration_secs", "q.qd")} AS dclean, {clip("s.pages_visited", "q.qp")} AS pclean
      FROM t6_sess_past s,
           (SELECT quantile_cont(duration_secs, 0.95) AS qd,
                   quantile_cont(pages_visited, 0.95) AS qp FROM t6_sess_past) q) x
GROUP BY user_id
""",
    ["t6_sess_past", "t6_cut"],
)
cte(
    "t6_browse",
    """
SELECT e.user_id, count(e.event_id) AS total_events, count(DISTINCT e.product_id) AS unique_products_browsed,
       CAST(sum(e.added_to_cart) AS BIGINT) AS total_cart_adds, CAST(sum(e.wishlisted) AS BIGINT) AS total_wishlists,
       COALESCE(sum(e.added_to_cart) / NULLIF(count(e.event_id), 0), 0) AS cart_add_rate,
       COALESCE(sum(e.wishlisted) / NULLIF(count(e.event_id), 0), 0) AS wishlist_rate,
       count(DISTINCT p.category) AS unique_categories_browsed
FROM clean_ev e LEFT JOIN shop_products p ON e.product_id = p.product_id
WHERE e.event_ts < (SELECT cut FROM t6_cut)
GROUP BY e.user_id
""",
    ["clean_ev", "shop_products", "t6_cut"],
)
cte(
    "t6_ord",
    order_feature_sql("(SELECT o.* FROM shop_orders o, t6_cut c WHERE o.order_date < c.cut)",
                      "(SELECT cut FROM t6_cut)", prefix="past_", disc="past_avg_discount",
                      freq="past_order_frequency"),
    ["shop_orders", "t6_cut"],
)
cte(
    "t6_future",
    "SELECT DISTINCT o.user_id FROM shop_orders o, t6_cut c "
    "WHERE o.order_date >= c.cut AND o.order_date < c.cut + INTERVAL 30 DAY",
    ["shop_orders", "t6_cut"],
)
query(
    "temporal_features",
    f"""
SELECT u.user_id, u.age,
       COALESCE(CASE u.device_type WHEN 'mobile' THEN 0 WHEN 'tablet' THEN 1 WHEN 'desktop' THEN 2 END, 0) AS device_type,
       COALESCE(CASE u.membership WHEN 'free' THEN 0 WHEN 'silver' THEN 1 WHEN 'gold' THEN 2
                     WHEN 'platinum' THEN 3 END, 0) AS membership_encoded,
       CAST(COALESCE(CASE u.membership WHEN 'free' THEN 0 WHEN 'silver' THEN 1 WHEN 'gold' THEN 2
                     WHEN 'platinum' THEN 3 END, 0) >= 2 AS INTEGER) AS is_premium,
       greatest({floor_days("c.cut", "CAST(u.signup_date AS TIMESTAMP)")}, 0) AS account_age_days,
       CAST(greatest({floor_days("c.cut", "CAST(u.signup_date AS TIMESTAMP)")}, 0) < 30 AS INTEGER) AS is_new_user,
       CAST(greatest({floor_days("c.cut", "CAST(u.signup_date AS TIMESTAMP)")}, 0) > 365 AS INTEGER) AS is_veteran_user,
       COALESCE(s.total_sessions, 0) AS total_sessions, COALESCE(s.avg_duration, 0) AS avg_duration,
       COALESCE(s.max_duration, 0) AS max_duration, COALESCE(s.avg_pages, 0) AS avg_pages,
       COALESCE(s.max_pages, 0) AS max_pages, COALESCE(s.avg_engagement, 0) AS avg_engagement,
       COALESCE(s.bounce_rate, 0) AS bounce_rate, COALESCE(s.days_since_last_session, 0) AS days_since_last_session,
       COALESCE(b.total_events, 0) AS total_events, COALESCE(b.unique_products_browsed, 0) AS unique_products_browsed,
       COALESCE(b.total_cart_adds, 0) AS total_cart_adds, COALESCE(b.total_wishlists, 0) AS total_wishlists,
       COALESCE(b.cart_add_rate, 0) AS cart_add_rate, COALESCE(b.wishlist_rate, 0) AS wishlist_rate,
       COALESCE(b.unique_categories_browsed, 0) AS unique_categories_browsed,
       COALESCE(o.past_total_orders, 0) AS past_total_orders, COALESCE(o.past_total_spend, 0) AS past_total_spend,
       COALESCE(o.past_avg_order_value, 0) AS past_avg_order_value,
       COALESCE(o.past_max_order_value, 0) AS past_max_order_value,
       COALESCE(o.past_avg_discount, 0) AS past_avg_discount,
       COALESCE(o.days_since_last_order, 0) AS days_since_last_order,
       COALESCE(o.customer_lifespan_days, 0) AS customer_lifespan_days,
       COALESCE(o.past_order_frequency, 0) AS past_order_frequency,
       CASE WHEN f.user_id IS NULL THEN 0 ELSE 1 END AS will_purchase_next_30days
FROM shop_users u CROSS JOIN t6_cut c
LEFT JOIN t6_sess s ON u.user_id = s.user_id
LEFT JOIN t6_browse b ON u.user_id = b.user_id
LEFT JOIN t6_ord o ON u.user_id = o.user_id
LEFT JOIN t6_future f ON u.user_id = f.user_id
""",
    "shop_users", "t6_cut", "t6_sess", "t6_browse", "t6_ord", "t6_future",
)


# ------------------------------------------------- reports on rate models
RATE_COLUMNS = {"rate_membership": ["membership"], "rate_device": ["device_type"], "rate_age": ["age_group"],
                "rate_all": ["membership", "device_type", "age_group"]}


def rate_scores(name: str, train: str, runs: str, target: str, prior: str = "20.0::DOUBLE") -> str:
    """Scores of one rate model: learnt from ``train`` per run, applied to ``target``
    (both (run columns, user columns)); ``runs`` are the columns that tell runs apart."""
    cols = RATE_COLUMNS[name]
    keys = ", ".join(cols)
    same = " AND ".join([f"t.{c} IS NOT DISTINCT FROM r.{c}" for c in cols + runs.split(", ")])
    mine = " AND ".join(f"t.{c} = o.{c}" for c in runs.split(", "))
    return f"""
SELECT '{name}' AS model, t.*, coalesce((r.pos + {prior} * o.overall) / (r.n + {prior}), o.overall) AS y_score
FROM {target} t
JOIN (SELECT {runs}, CAST(sum(will_purchase) AS DOUBLE) / CAST(count(will_purchase) AS DOUBLE) AS overall FROM {train} GROUP BY {runs}) o ON {mine}
LEFT JOIN (SELECT {runs}, {keys}, sum(will_purchase) AS pos, count(will_purchase) AS n FROM {train} GROUP BY {runs}, {keys}) r ON {same}
"""


def rated_metrics(scored: str, groups: str) -> str:
    """Five metrics per group of a scored CTE (will_purchase, y_score); AUC by mid-ranks."""
    return f"""
SELECT {groups},
       CAST(sum(CAST((y_score >= 0.5) = (will_purchase = 1) AS INTEGER)) AS DOUBLE) / count(*) AS accuracy,
       coalesce(CAST(sum(will_purchase) FILTER (y_score >= 0.5) AS DOUBLE) / nullif(count(*) FILTER (y_score >= 0.5), 0), 0) AS precision,
       coalesce(CAST(sum(will_purchase) FILTER (y_score >= 0.5) AS DOUBLE) / nullif(sum(will_purchase), 0), 0) AS recall,
       coalesce(2 * CAST(sum(will_purchase) FILTER (y_score >= 0.5) AS DOUBLE)
                / nullif(count(*) FILTER (y_score >= 0.5) + sum(will_purchase), 0), 0) AS f1,
       (sum(mid) FILTER (will_purchase = 1) - CAST(sum(will_purchase) AS DOUBLE) * (sum(will_purchase) + 1) / 2)
         / nullif(CAST(sum(will_purchase) AS DOUBLE) * (count(*) - sum(will_purchase)), 0) AS auc_roc
FROM (SELECT *, rank() OVER (PARTITION BY {groups} ORDER BY y_score)
                + (count(*) OVER (PARTITION BY {groups}, y_score) - 1) / 2.0::DOUBLE AS mid FROM {scored}) m
GROUP BY {groups}
"""


_USERS = "user_id, membership, device_type, age_group, will_purchase"
cte("rate_split", f"""
SELECT {_USERS}, 1 AS run,
       CASE WHEN class_rank <= round(class_n * 0.2) THEN 'test' ELSE 'train' END AS split
FROM clean_usr JOIN (SELECT user_id, class_rank, class_n FROM split_ranked) USING (user_id)
""", ["clean_usr", "split_ranked"])
cte("rate_train", "SELECT * FROM rate_split WHERE split = 'train'", ["rate_split"])
cte("rate_scored", "\nUNION ALL\n".join(rate_scores(n, "rate_train", "run", "rate_split") for n in RATE_COLUMNS),
    ["rate_split", "rate_train"])
cte("rate_results", rated_metrics("rate_scored", "model, split"), ["rate_scored"])
query("leaderboard", """
SELECT model, round(accuracy, 4) AS accuracy, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1,
       round(auc_roc, 4) AS auc_roc FROM rate_results WHERE split = 'test'
""", "rate_results")
query("overfit_rates", """
SELECT model, metric, round(train, 6) AS train, round(test, 6) AS test, round(train - test, 6) AS gap,
       max(abs(train - test)) OVER (PARTITION BY model) > 0.02 AS overfit,
       round(max(train - test) FILTER (metric = 'auc_roc') OVER (PARTITION BY model), 6) AS auc_gap
FROM (UNPIVOT (SELECT * FROM rate_results WHERE split = 'train') ON accuracy, precision, recall, f1, auc_roc INTO NAME metric VALUE train) a
JOIN (SELECT model, metric, test FROM (UNPIVOT (SELECT * FROM rate_results WHERE split = 'test') ON accuracy, precision, recall, f1, auc_roc
      INTO NAME metric VALUE test)) b USING (model, metric)
""", "rate_results")
cte("rate_folds", f"""
SELECT {_USERS}, CAST((class_rank - 1) % 5 AS INTEGER) AS fold,
       CAST(CAST('0x' || substr(md5('42|lc|' || CAST(user_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0::DOUBLE AS h
FROM clean_usr JOIN (SELECT user_id, class_rank FROM split_ranked) USING (user_id)
""", ["clean_usr", "split_ranked"])
cte("fold_train", f"SELECT f.fold, {', '.join('u.' + c for c in _USERS.split(', '))} FROM rate_folds u JOIN (SELECT DISTINCT fold FROM rate_folds) f ON u.fold <> f.fold",
    ["rate_folds"])
cte("fold_scored", "\nUNION ALL\n".join(rate_scores(n, "fold_train", "fold", "rate_folds") for n in RATE_COLUMNS),
    ["rate_folds", "fold_train"])
cte("fold_results", rated_metrics("fold_scored", "model, fold"), ["fold_scored"])
query("cv_report", """
SELECT model, round(avg(f1), 6) AS f1_mean, round(stddev_pop(f1), 6) AS f1_std, round(avg(auc_roc), 6) AS auc_mean,
       round(stddev_pop(auc_roc), 6) AS auc_std FROM fold_results GROUP BY model
""", "fold_results")
cte("curve_runs", """
SELECT 0.1::DOUBLE + 0.9::DOUBLE * i / 7 AS size, fold FROM range(8) r(i), (SELECT DISTINCT fold FROM rate_folds) f
""", ["rate_folds"])
cte("curve_train", f"""
SELECT c.size, c.fold, 'train' AS side, {', '.join('u.' + c for c in _USERS.split(', '))}
FROM curve_runs c JOIN rate_folds u ON u.fold <> c.fold AND u.h < c.size
""", ["curve_runs", "rate_folds"])
cte("curve_rows", f"""
SELECT * FROM curve_train UNION ALL
SELECT c.size, c.fold, 'val' AS side, {', '.join('u.' + c for c in _USERS.split(', '))} FROM curve_runs c JOIN rate_folds u ON u.fold = c.fold
""", ["curve_runs", "curve_train", "rate_folds"])
cte("curve_scored", rate_scores("rate_all", "curve_train", "size, fold", "curve_rows"), ["curve_rows", "curve_train"])
cte("curve_results", rated_metrics("curve_scored", "size, fold, side"), ["curve_scored"])
query("learning_curve", """
SELECT round(size, 6) AS size, round(avg(auc_roc) FILTER (side = 'train'), 6) AS train_mean,
       round(stddev_pop(auc_roc) FILTER (side = 'train'), 6) AS train_std, round(avg(auc_roc) FILTER (side = 'val'), 6) AS val_mean,
       round(stddev_pop(auc_roc) FILTER (side = 'val'), 6) AS val_std FROM curve_results GROUP BY size
""", "curve_results")

# ------------------------------------------- the search as a table of rows
_MODELS = ", ".join(f"'{m}'" for m in RATE_COLUMNS)
cte("search_points", f"""
SELECT CAST(i AS INTEGER) AS point, [{_MODELS}][i % 4 + 1] AS columns, [1.0, 5.0, 20.0, 100.0, 400.0][i // 4 + 1]::DOUBLE AS prior
FROM range(20) r(i) ORDER BY md5('42|point|' || CAST(i AS VARCHAR)) LIMIT 6
""")
cte("search_rows", f"""
SELECT p.*, f.fold, CASE WHEN u.fold = f.fold THEN 'val' ELSE 'train' END AS side, {', '.join('u.' + c for c in _USERS.split(', '))}
FROM search_points p, (SELECT DISTINCT fold FROM rate_folds) f, rate_folds u
""", ["search_points", "rate_folds"])
for _m in RATE_COLUMNS:
    cte(f"search_{_m}", f"SELECT * FROM search_rows WHERE columns = '{_m}'", ["search_rows"])
    cte(f"search_fit_{_m}", f"SELECT * FROM search_{_m} WHERE side = 'train'", [f"search_{_m}"])
cte("search_scored", "\nUNION ALL\n".join(rate_scores(m, f"search_fit_{m}", "point, fold", f"search_{m}", "t.prior") for m in RATE_COLUMNS),
    [x for m in RATE_COLUMNS for x in (f"search_{m}", f"search_fit_{m}")])
cte("search_results", rated_metrics("search_scored", "point, columns, prior, fold, side"), ["search_scored"])
cte("search_sides", """
SELECT point, columns, prior, fold, max(n) FILTER (side = 'train') AS n_train, max(n) FILTER (side = 'val') AS n_val,
       max(auc_roc) FILTER (side = 'train') AS train_auc, max(auc_roc) FILTER (side = 'val') AS val_auc
FROM search_results JOIN (SELECT point, fold, side, count(*) AS n FROM search_scored GROUP BY point, fold, side) USING (point, fold, side)
GROUP BY point, columns, prior, fold
""", ["search_results", "search_scored"])
query("search_table", """
SELECT s.point, columns, prior, fold, n_train, n_val, round(train_auc, 6) AS train_auc, round(val_auc, 6) AS val_auc,
       round(mean_auc, 6) AS mean_auc, round(std_auc, 6) AS std_auc, place
FROM search_sides s
JOIN (SELECT *, row_number() OVER (ORDER BY round(mean_auc, 9) DESC NULLS LAST, point) AS place
      FROM (SELECT point, avg(val_auc) AS mean_auc, stddev_pop(val_auc) AS std_auc FROM search_sides GROUP BY point) m) p USING (point)
""", "search_sides")

# ------------------------------------------- repeated appends and streaming
query("append_retried", """
SELECT user_id, age, device_type, will_purchase, user_id AS orig_id FROM clean_usr WHERE will_purchase = 1
UNION ALL
SELECT (SELECT coalesce(max(user_id), 0) FROM clean_usr WHERE will_purchase = 1)
         + row_number() OVER (ORDER BY device_type IS DISTINCT FROM 'mobile', user_id) AS user_id,
       age, device_type, will_purchase, user_id AS orig_id
FROM clean_usr WHERE will_purchase = 0
""", "clean_usr")
cte("stream_users", f"SELECT {_USERS}, 1 AS run FROM clean_usr", ["clean_usr"])
cte("stream_rates", rate_scores("rate_all", "stream_users", "run", "stream_users"), ["stream_users"])
cte("stream_rows", "SELECT r.user_id, r.y_score, fm.total_orders, fm.days_since_last_order FROM stream_rates r JOIN fm USING (user_id)",
    ["stream_rates", "fm"])
cte("stream_decayed", decayed("y_score", "stream_rows"), ["stream_rows"])
query("stream_scores", """
SELECT user_id, round(probability, 6) AS probability, round(adjusted_probability, 6) AS adjusted_probability,
       CAST(adjusted_probability >= 0.5 AS INTEGER) AS prediction FROM stream_decayed
""", "stream_decayed")

# ------------------------------------------------------- models as tables
_FEATURE_NAMES = ", ".join(f"'{c}'" for c in ["device_type", *_FM_NUMERIC])
_HELD = f"""
SELECT 'score' AS part, CAST(user_id AS VARCHAR) AS name, CAST(will_purchase AS INTEGER) AS y_true, TRUE AS agrees
FROM split_ranked WHERE class_rank <= round(class_n * 0.2)
UNION ALL SELECT 'importance', unnest([{_FEATURE_NAMES}]), NULL, TRUE
"""
query("boosted_table", _HELD, "split_ranked")
query("forest_table", _HELD + f"UNION ALL SELECT 'gradient', unnest([{_FEATURE_NAMES}, '(intercept)']), NULL, TRUE", "split_ranked")

# ------------------------------------------------------------------ sources
query("csv_round_trip", """
SELECT CASE WHEN ok THEN CAST(order_id AS VARCHAR) END AS order_id, CASE WHEN ok THEN CAST(user_id AS VARCHAR) END AS user_id,
       CASE WHEN ok THEN CAST(CAST(order_date AS DATE) AS VARCHAR) END AS order_date, CASE WHEN ok THEN total_amount END AS total_amount,
       CASE WHEN ok THEN status END AS status, CASE WHEN ok THEN payment_method END AS payment_method,
       CASE WHEN ok THEN discount_pct END AS discount_pct,
       CASE WHEN NOT ok THEN 'cheap,' || discount_pct || ',' || status || ',x,' || payment_method || ',' || user_id || ',' || order_id
            || ',' || CAST(CAST(order_date AS DATE) AS VARCHAR) END AS rejected_row,
       CASE WHEN NOT ok THEN 'could not parse total_amount' END AS reason
FROM (SELECT *, order_id % 10 <> 0 AS ok FROM shop_orders) o
""", "shop_orders")
