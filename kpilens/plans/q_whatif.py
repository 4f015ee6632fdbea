"""Registered queries: what-if transforms (J1-J8), with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpilens.operators import whatif as J
from kpilens.operators.stamps import flipped_items, flipped_orders
from kpilens.plans.q_profile import STAMPS_CTE, later_sql
from kpilens.plans.registry import kpi, periods, register
from kpilens.plans.sql_base import ts, with_
from kpilens.session import kept

ORACLE: dict[str, str] = {}

SURGE_SOURCE = "BUILDING"
SURGE_MULTIPLIER = 3.0
FLIP_RATE = 0.8
#: Fixture mapping: the events begin 8,219 days after July 2001, the month whose orders are dropped.
SESSION_SHIFT = "INTERVAL '8219' DAY"


def purchase_items(spark, d):
    """Purchase events stand for sold items carrying (user, time)."""
    e = kpi(spark, d).star.events
    return e.filter(F.col("event_type") == "purchase").select(F.col("event_id").alias("item_id"), "user_id", "ts")


def purchase_sessions(spark, d):
    return kpi(spark, d).sessions.filter("purchased").select("session_id", "user_id", "started_at")


@register("orders_of_source")
def orders_of_source(spark, d):
    """Last month's orders of users acquired through one source."""
    k, p = kpi(spark, d), periods(spark, d)
    return J.orders_of_source(k.star, p["last_month"][0], SURGE_SOURCE).select("order_id", "user_id", "status",
                                                                                "created_at")


ORACLE["orders_of_source"] = with_("o", "u", "per") + f"""
SELECT order_id, user_id, status, {ts('created_at')} AS created_at FROM o
WHERE strftime(created_at, '%Y-%m') = (SELECT month FROM per WHERE cur1)
  AND user_id IN (SELECT id FROM u WHERE traffic_source = '{SURGE_SOURCE}')"""


def _candidates(spark, d):
    k, p = kpi(spark, d), periods(spark, d)
    return J.orders_all_from_segment(k.fact, p["previous_month"] + p["last_month"], "dist_center")


@register("orders_all_from_segment")
def orders_all_from_segment(spark, d):
    """Orders of the last two months served entirely by one centre (the centre with
    the most such orders), not already lost."""
    return _candidates(spark, d).select("order_id", "month", "segment")


CAND_SQL = """
cand0 AS (SELECT order_id, month, MIN(dist_center) AS segment FROM fact JOIN per USING (month)
          WHERE (per.cur1 OR per.prev1) AND NOT lost GROUP BY order_id, month HAVING COUNT(DISTINCT dist_center) = 1),
top AS (SELECT segment FROM cand0 GROUP BY segment ORDER BY COUNT(*) DESC, segment LIMIT 1),
cand AS (SELECT * FROM cand0 WHERE segment = (SELECT segment FROM top))"""

ORACLE["orders_all_from_segment"] = with_("fact", "per", extra=CAND_SQL) + "SELECT order_id, month, segment FROM cand"


@register("sample_exact")
def sample_exact(spark, d):
    """Exactly round(0.8 n) of those orders per month, md5 order."""
    return J.sample_exact(_candidates(spark, d), "order_id", FLIP_RATE, by=["month"]).select("order_id", "month")


SAMPLE_SQL = CAND_SQL + f""",
hashed AS (SELECT *, CAST(('0x' || substr(md5(CAST(order_id AS VARCHAR)), 1, 13)) AS BIGINT) AS h,
                  COUNT(*) OVER (PARTITION BY month) AS n FROM cand),
picked AS (SELECT order_id, month FROM (
             SELECT *, ROW_NUMBER() OVER (PARTITION BY month ORDER BY h, order_id) AS r FROM hashed) t
           WHERE r <= round_even({FLIP_RATE} * n, 0))"""

ORACLE["sample_exact"] = with_("fact", "per", extra=SAMPLE_SQL) + "SELECT order_id, month FROM picked"


def flip_edit(spark, d):
    k = kpi(spark, d)
    picked = J.sample_exact(_candidates(spark, d), "order_id", FLIP_RATE, by=["month"])
    return J.flip_to_returned(k.star, picked)


@register("what_if_flip")
def what_if_flip(spark, d):
    """The picked orders turned Returned: the report of the edit."""
    return flip_edit(spark, d)[1]


ORACLE["what_if_flip"] = with_("fact", "per", extra=SAMPLE_SQL) + """
SELECT (SELECT COUNT(*) FROM picked) AS orders,
       (SELECT COUNT(*) FROM picked JOIN o USING (order_id) WHERE o.status IN ('Cancelled', 'Returned')) AS already_lost,
       (SELECT COUNT(*) FROM oi WHERE order_id IN (SELECT order_id FROM picked)) AS items,
       (SELECT ROUND(CAST(SUM(oi.sale_price) AS DOUBLE), 6) FROM oi JOIN o USING (order_id)
         WHERE oi.order_id IN (SELECT order_id FROM picked) AND o.status NOT IN ('Cancelled', 'Returned'))
           AS revenue_moved_out_of_net"""


def _flip_picks(spark, d):
    return J.sample_exact(_candidates(spark, d), "order_id", FLIP_RATE, by=["month"])


@register("what_if_flip_orders")
def what_if_flip_orders(spark, d):
    """The edited orders table: the picked ones Returned, every stamp they lacked filled along a monotone chain."""
    return flipped_orders(kpi(spark, d).star, _flip_picks(spark, d)).select(
        "order_id", "user_id", "status", "created_at", "shipped_at", "delivered_at", "returned_at", "edited")


@register("what_if_flip_items")
def what_if_flip_items(spark, d):
    """The edited items table: status and later stamps follow the order's."""
    star = kpi(spark, d).star
    return flipped_items(star, flipped_orders(star, _flip_picks(spark, d))).select(
        "order_id", "line_number", "product_id", "sale_price", "status", "shipped_at", "delivered_at", "returned_at", "edited")


FLIPPED_SQL = SAMPLE_SQL + ",\n" + STAMPS_CTE + f""",
fl0 AS (SELECT st.*, st.order_id IN (SELECT order_id FROM picked) AS edited FROM st),
fl1 AS (SELECT * REPLACE (CASE WHEN edited THEN COALESCE(shipped_at, {later_sql('created_at', 'shipped')}) ELSE shipped_at END AS shipped_at)
        FROM fl0),
fl2 AS (SELECT * REPLACE (CASE WHEN edited THEN COALESCE(delivered_at, {later_sql('shipped_at', 'delivered')}) ELSE delivered_at END
                          AS delivered_at) FROM fl1),
fl AS (SELECT * REPLACE (CASE WHEN edited THEN COALESCE(returned_at, {later_sql('delivered_at', 'returned')}) ELSE returned_at END
                         AS returned_at, CASE WHEN edited THEN 'Returned' ELSE status END AS status) FROM fl2)"""

ORACLE["what_if_flip_orders"] = with_("fact", "per", extra=FLIPPED_SQL) + f"""
SELECT order_id, user_id, status, {ts('created_at')} AS created_at, {ts('shipped_at')} AS shipped_at,
       {ts('delivered_at')} AS delivered_at, {ts('returned_at')} AS returned_at, edited FROM fl"""
ORACLE["what_if_flip_items"] = with_("fact", "per", extra=FLIPPED_SQL) + f"""
SELECT oi.order_id, oi.line_number, oi.product_id, ROUND(CAST(oi.sale_price AS DOUBLE), 6) AS sale_price, fl.status,
       {ts('oi.created_at')} AS shipped_at, {ts('fl.delivered_at')} AS delivered_at, {ts('fl.returned_at')} AS returned_at, fl.edited
FROM oi LEFT JOIN fl ON fl.order_id = oi.order_id"""


@register("what_if_drop")
def what_if_drop(spark, d):
    """Last month's orders of one source removed with their items."""
    k, p = kpi(spark, d), periods(spark, d)
    picked = J.orders_of_source(k.star, p["last_month"][0], SURGE_SOURCE)
    return J.drop_orders(k.star, picked)[1]


ORACLE["what_if_drop"] = with_("o", "oi", "u", "per", extra=f"""
dropped AS (SELECT order_id FROM o WHERE strftime(created_at, '%Y-%m') = (SELECT month FROM per WHERE cur1)
              AND user_id IN (SELECT id FROM u WHERE traffic_source = '{SURGE_SOURCE}'))""") + """
SELECT (SELECT COUNT(*) FROM o) AS orders_before,
       (SELECT COUNT(*) FROM o WHERE order_id NOT IN (SELECT order_id FROM dropped)) AS orders_after,
       (SELECT COUNT(*) FROM oi) AS items_before,
       (SELECT COUNT(*) FROM oi WHERE order_id NOT IN (SELECT order_id FROM dropped)) AS items_after,
       (SELECT ROUND(COALESCE(CAST(SUM(sale_price) AS DOUBLE), 0), 6) FROM oi WHERE order_id IN (SELECT order_id FROM dropped))
           AS revenue_removed"""


def greedy_sql(items: str) -> str:
    """CTEs for the one-to-one match of `items` (item_id, user_id, ts): each user's n-th item takes the first
    of its candidates (nearest, earlier start, id) that is in nobody's list of used sessions."""
    return f"""
turn AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, item_id) AS n FROM {items} WHERE user_id IS NOT NULL),
cand AS (SELECT t.user_id, t.n, t.item_id,
                list(s.session_id ORDER BY ABS(epoch_us(s.started_at) - epoch_us(t.ts)), s.started_at, s.session_id)
                    FILTER (s.session_id IS NOT NULL) AS near
         FROM turn t LEFT JOIN sess s ON s.user_id = t.user_id AND s.purchased
              AND epoch_us(s.started_at) - epoch_us(t.ts) BETWEEN -259200000000 AND 86400000000
         GROUP BY t.user_id, t.n, t.item_id),
step AS (SELECT user_id, 0::BIGINT AS n, []::VARCHAR[] AS used, NULL::VARCHAR AS session_id
         FROM (SELECT DISTINCT user_id FROM turn)
         UNION ALL
         SELECT user_id, n, CASE WHEN pick IS NULL THEN used ELSE list_append(used, pick) END, pick
         FROM (SELECT c.user_id, c.n, step.used,
                      list_filter(c.near, lambda x: NOT list_contains(step.used, x))[1] AS pick
               FROM step JOIN cand c ON c.user_id = step.user_id AND c.n = step.n + 1)),
matched AS (SELECT cand.item_id, user_id, step.session_id FROM step JOIN cand USING (user_id, n) WHERE step.session_id IS NOT NULL)"""


DROPPED_SQL = f"""
dropped AS (SELECT order_id, user_id FROM o WHERE strftime(created_at, '%Y-%m') = (SELECT month FROM per WHERE cur1)
              AND user_id IN (SELECT id FROM u WHERE traffic_source = '{SURGE_SOURCE}')),
gone AS (SELECT concat_ws('|', oi.order_id, line_number, product_id, supplier_id, sale_price, quantity, line_status, created_at) AS item_id,
                d.user_id, oi.created_at + {SESSION_SHIFT} AS ts, sale_price
         FROM oi JOIN dropped d ON d.order_id = oi.order_id),""" + greedy_sql("gone")


def _drop_cascade(spark, d):
    k, p = kpi(spark, d), periods(spark, d)
    picked = kept(J.orders_of_source(k.star, p["last_month"][0], SURGE_SOURCE), "picked-orders")
    o = kept(k.star.orders.join(picked.select("order_id"), "order_id", "left_semi").select("order_id", "user_id"), "dropped-heads")
    items = (k.star.order_items.join(o, "order_id")
             .select(J.item_key().alias("item_id"), "user_id", (F.col("created_at") + F.expr(SESSION_SHIFT)).alias("ts")))
    items = kept(items, "dropped-items")
    sessions = purchase_sessions(spark, d)
    return J.drop_orders(k.star, picked, sessions, J.nearest_session_1to1(items, sessions))


@register("what_if_drop_sessions")
def what_if_drop_sessions(spark, d):
    """J5 cascade: the report of dropping last month's orders of one source with their items and the purchase
    session that produced each item (one-to-one nearest match in [-3 d, +1 d])."""
    return _drop_cascade(spark, d)[1]


ORACLE["what_if_drop_sessions"] = with_("o", "oi", "u", "per", "sess", extra=DROPPED_SQL).replace("WITH ", "WITH RECURSIVE ", 1) + """
SELECT (SELECT COUNT(*) FROM o) AS orders_before,
       (SELECT COUNT(*) FROM o WHERE order_id NOT IN (SELECT order_id FROM dropped)) AS orders_after,
       (SELECT COUNT(*) FROM oi) AS items_before,
       (SELECT COUNT(*) FROM oi WHERE order_id NOT IN (SELECT order_id FROM dropped)) AS items_after,
       (SELECT ROUND(COALESCE(CAST(SUM(sale_price) AS DOUBLE), 0), 6) FROM gone) AS revenue_removed,
       (SELECT COUNT(*) FROM matched) AS sessions_removed,
       (SELECT COUNT(*) FROM gone) - (SELECT COUNT(*) FROM matched) AS items_without_session"""


@register("what_if_drop_remaining")
def what_if_drop_remaining(spark, d):
    """J5 cascade: the purchase sessions that remain, as an edited table."""
    return _drop_cascade(spark, d)[2].select("session_id", "user_id", "started_at")


ORACLE["what_if_drop_remaining"] = with_("o", "oi", "u", "per", "sess", extra=DROPPED_SQL).replace("WITH ", "WITH RECURSIVE ", 1) + f"""
SELECT session_id, user_id, {ts('started_at')} AS started_at FROM sess
WHERE purchased AND session_id NOT IN (SELECT session_id FROM matched)"""


@register("nearest_session")
def nearest_session(spark, d):
    """J6 (plain): each purchase's nearest purchase session of the same user in [-3 d, +1 d]."""
    return J.nearest_session(purchase_items(spark, d), purchase_sessions(spark, d))


ORACLE["nearest_session"] = with_("sess", extra="""
it AS (SELECT event_id AS item_id, user_id, ts FROM events WHERE event_type = 'purchase'),
c AS (SELECT it.item_id, it.user_id, s.session_id, s.started_at,
             ABS(epoch_us(s.started_at) - epoch_us(it.ts)) AS abs_us
      FROM it JOIN sess s ON s.user_id = it.user_id
      WHERE s.purchased AND epoch_us(s.started_at) - epoch_us(it.ts) BETWEEN -259200000000 AND 86400000000)""") + """
SELECT item_id, user_id, session_id, abs_us FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY abs_us, started_at, session_id) AS r FROM c) t
WHERE r = 1"""


@register("nearest_session_1to1")
def nearest_session_1to1(spark, d):
    """J6 (one-to-one): greedy in time order per user, streamed past the sessions still in reach."""
    return J.nearest_session_1to1(purchase_items(spark, d), purchase_sessions(spark, d))


ORACLE["nearest_session_1to1"] = with_("sess", extra="""
it AS (SELECT event_id AS item_id, user_id, ts FROM events WHERE event_type = 'purchase'),""" + greedy_sql("it")).replace(
    "WITH ", "WITH RECURSIVE ", 1) + "SELECT item_id, user_id, session_id FROM matched"


def surge_edit(spark, d):
    k, p = kpi(spark, d), periods(spark, d)
    return J.surge(k.star, p["last_month"][0], SURGE_SOURCE, SURGE_MULTIPLIER, new_users=True)


@register("what_if_surge")
def what_if_surge(spark, d):
    """Last month's orders of one source tripled with new keys and new users."""
    return surge_edit(spark, d)[1]


SURGE_SQL = f"""
pool AS (SELECT * FROM o WHERE strftime(created_at, '%Y-%m') = (SELECT month FROM per WHERE cur1)
           AND user_id IN (SELECT id FROM u WHERE traffic_source = '{SURGE_SOURCE}')),
b AS (SELECT MIN(order_id) AS mn, MAX(order_id) AS pmax FROM pool),
mx AS (SELECT (SELECT MAX(order_id) FROM o) AS omax, (SELECT MAX(id) FROM u) AS umax),
new_orders AS (
  SELECT mx.omax + (c.copy - 1) * (b.pmax - b.mn + 1) + (pool.order_id - b.mn + 1) AS order_id,
         mx.umax + (c.copy - 1) * (b.pmax - b.mn + 1) + (pool.order_id - b.mn + 1) AS user_id,
         pool.status, pool.created_at, pool.total_price, pool.order_id AS source_order_id,
         pool.user_id AS source_user_id
  FROM pool CROSS JOIN b CROSS JOIN mx CROSS JOIN (SELECT UNNEST(generate_series(1, {int(SURGE_MULTIPLIER - 1)})) AS copy) c)"""

ORACLE["what_if_surge"] = with_("o", "u", "per", extra=SURGE_SQL) + f"""
SELECT order_id, user_id, status, {ts('created_at')} AS created_at, ROUND(total_price, 6) AS total_price,
       source_order_id, source_user_id FROM new_orders"""
