"""Registered queries: sessions (B7), funnel (G1-G4) and leakage (G5-G8), with oracle SQL."""

from __future__ import annotations

import uuid

from kpilens.operators import cube as C
from kpilens.operators import funnel as G
from kpilens.plans.registry import kpi, periods, register
from kpilens.plans.sql_base import TODAY_MONTH, ts, with_
from kpilens.session import ensure_checkpoint_dir
from kpilens.streaming.exact_sessions import sessionize_exact
from kpilens.streaming.sessions import read_events_stream, start_sessions_sink

ORACLE: dict[str, str] = {}


def _session_periods(spark, d) -> tuple[str, str]:
    ps = kpi(spark, d).session_periods()
    return ps[-2], ps[-1]


@register("sessions_from_events")
def sessions_from_events(spark, d):
    """Sessionised events (6 h gap), dimensions of the first event, flags."""
    return kpi(spark, d).sessions


ORACLE["sessions_from_events"] = with_("sess") + f"""
SELECT session_id, user_id, traffic_source, browser, {ts('started_at')} AS started_at, n_events, saw_product,
       added_to_cart, purchased, period FROM sess"""


@register("sessions_stream_exact")
def sessions_stream_exact(spark, d):
    """B7 as a stream: the events replayed with the batch rule (gap > 6 h); the sessions the watermark has closed."""
    out = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kpilens-sessions-{uuid.uuid4().hex}"
    stream = read_events_stream(spark, f"{d.rstrip('/')}/events.parquet")
    start_sessions_sink(sessionize_exact(stream), out).awaitTermination()
    return spark.read.parquet(out)


ORACLE["sessions_stream_exact"] = with_("evs", extra="""
runs AS (SELECT user_id, session_no, arg_min(CAST(json_extract_string(props, '$.k') AS BIGINT), (ts, event_id)) AS k,
                MIN(ts) AS started_at, MAX(ts) AS last_at, COUNT(*) AS n_events, bool_or(event_type = 'view') AS saw_product,
                bool_or(event_type = 'click') AS added_to_cart, bool_or(event_type = 'purchase') AS purchased
         FROM evs WHERE ts IS NOT NULL GROUP BY 1, 2)""") + f"""
SELECT user_id AS raw_user_id, CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id, 'S' || CAST(k % 5 AS VARCHAR) AS traffic_source,
       'B' || CAST(k % 4 AS VARCHAR) AS browser, {ts('started_at')} AS started_at, n_events, saw_product, added_to_cart, purchased,
       strftime(date_trunc('week', started_at), '%Y-%m-%d') AS period
FROM runs WHERE epoch_us(last_at) + CAST(21600000000 AS BIGINT)
              < (SELECT (epoch_us(MAX(ts)) // 1000 - 86400000) * 1000 FROM events)"""


def _rates(where: str, key: str) -> str:
    return f"""SELECT {key} AS segment, COUNT(*) AS sessions,
       ROUND(AVG(CAST(added_to_cart AS INT)), 6) AS cart_rate, ROUND(AVG(CAST(purchased AS INT)), 6) AS purchase_rate
FROM sess WHERE {where} GROUP BY 1"""


@register("funnel_total")
def funnel_total(spark, d):
    """G1 (R15): sessions, cart and purchase rate of the last complete period."""
    return G.funnel(kpi(spark, d).sessions, _session_periods(spark, d)[1])


ORACLE["funnel_total"] = with_("sess", "sp") + _rates("period = (SELECT cur FROM sp)", "'all'")


@register("funnel_by_source")
def funnel_by_source(spark, d):
    """The funnel of the last complete period by SESSION source."""
    return G.funnel(kpi(spark, d).sessions, _session_periods(spark, d)[1], "traffic_source")


ORACLE["funnel_by_source"] = with_("sess", "sp") + _rates("period = (SELECT cur FROM sp)",
                                                          "COALESCE(traffic_source, '(unknown)')")


@register("funnel_by_browser")
def funnel_by_browser(spark, d):
    """The funnel of the last complete period by browser."""
    return G.funnel(kpi(spark, d).sessions, _session_periods(spark, d)[1], "browser")


ORACLE["funnel_by_browser"] = with_("sess", "sp") + _rates("period = (SELECT cur FROM sp)",
                                                           "COALESCE(browser, '(unknown)')")


@register("funnel_by_period")
def funnel_by_period(spark, d):
    """Sessions and rates of the last 4 periods (never compare across periods, R15)."""
    return G.funnel_by_period(kpi(spark, d).sessions, 4)


ORACLE["funnel_by_period"] = with_("sess") + """
SELECT period, COUNT(*) AS sessions, ROUND(AVG(CAST(saw_product AS INT)), 6) AS saw_product,
       ROUND(AVG(CAST(added_to_cart AS INT)), 6) AS added_to_cart, ROUND(AVG(CAST(purchased AS INT)), 6) AS purchased
FROM sess GROUP BY period ORDER BY period DESC LIMIT 4"""


@register("funnel_two_period")
def funnel_two_period(spark, d):
    """By session source and by browser, the last two complete periods side by side."""
    prev, cur = _session_periods(spark, d)
    return G.funnel_two_period(kpi(spark, d).sessions, prev, cur)


ORACLE["funnel_two_period"] = with_("sess", "sp") + "\nUNION ALL\n".join(f"""
SELECT '{dim}' AS dimension, COALESCE({dim}, '(unknown)') AS segment,
       SUM(CASE WHEN period = sp.prev THEN 1 ELSE 0 END) AS sessions_prev,
       SUM(CASE WHEN period = sp.cur THEN 1 ELSE 0 END) AS sessions_cur,
       ROUND(AVG(CASE WHEN period = sp.prev THEN CAST(purchased AS INT) END), 6) AS conv_prev,
       ROUND(AVG(CASE WHEN period = sp.cur THEN CAST(purchased AS INT) END), 6) AS conv_cur,
       ROUND(CASE WHEN SUM(CASE WHEN period = sp.prev THEN 1 ELSE 0 END) <> 0 THEN
         100 * (CAST(SUM(CASE WHEN period = sp.cur THEN 1 ELSE 0 END) AS DOUBLE)
                / SUM(CASE WHEN period = sp.prev THEN 1 ELSE 0 END) - 1) END, 6) AS sessions_chg_pct
FROM sess CROSS JOIN sp WHERE period IN (sp.prev, sp.cur) GROUP BY 1, 2""" for dim in ("traffic_source", "browser"))


@register("leakage_orders")
def leakage_orders(spark, d):
    """G5 (R21): share of the last month's orders cancelled / returned."""
    return C.leakage(kpi(spark, d).cube, periods(spark, d)["last_month"][0])


ORACLE["leakage_orders"] = with_("ords", "per") + """
SELECT ROUND(AVG(CASE WHEN order_status = 'Cancelled' THEN 1 ELSE 0 END), 6) AS cancelled,
       ROUND(AVG(CASE WHEN order_status = 'Returned' THEN 1 ELSE 0 END), 6) AS returned
FROM ords JOIN per USING (month) WHERE per.cur1 AND order_status IS NOT NULL"""


@register("leakage_by_dim")
def leakage_by_dim(spark, d):
    """G6 (R21): by distribution centre, revenue share in cancelled / returned orders."""
    return C.leakage_by_dim(kpi(spark, d).cube, periods(spark, d)["last_month"][0], "dist_center")


ORACLE["leakage_by_dim"] = with_("fact", "per") + """
SELECT dist_center AS segment, ROUND(CAST(SUM(sale_price) AS DOUBLE), 6) AS revenue,
       ROUND(CAST(SUM(CASE WHEN order_status = 'Cancelled' THEN sale_price ELSE 0 END) AS DOUBLE)
             / NULLIF(CAST(SUM(sale_price) AS DOUBLE), 0), 6) AS cancelled,
       ROUND(CAST(SUM(CASE WHEN order_status = 'Returned' THEN sale_price ELSE 0 END) AS DOUBLE)
             / NULLIF(CAST(SUM(sale_price) AS DOUBLE), 0), 6) AS returned
FROM fact JOIN per USING (month) WHERE per.cur1 GROUP BY 1"""


@register("status_share_by_month")
def status_share_by_month(spark, d):
    """Order share of every status, per complete month."""
    return C.status_share_by_month(kpi(spark, d).cube, TODAY_MONTH)


ORACLE["status_share_by_month"] = with_("ords") + f"""
SELECT month, {', '.join(f"ROUND(AVG(CASE WHEN order_status = '{s}' THEN 1 ELSE 0 END), 6) AS {s.lower()}"
                         for s in ('Processing', 'Shipped', 'Complete', 'Cancelled', 'Returned'))}
FROM ords WHERE month < '{TODAY_MONTH}' GROUP BY month"""


@register("item_return_rate")
def item_return_rate(spark, d):
    """Items and % of items in returned orders per centre, last two months pooled."""
    p = periods(spark, d)
    return C.item_return_rate(kpi(spark, d).cube, p["previous_month"] + p["last_month"])


ORACLE["item_return_rate"] = with_("fact", "per") + """
SELECT dist_center AS segment, COUNT(*) AS items,
       ROUND(100 * AVG(CASE WHEN order_status = 'Returned' THEN 1 ELSE 0 END), 6) AS returned_pct
FROM fact JOIN per USING (month) WHERE per.cur1 OR per.prev1 GROUP BY 1"""
