"""Registered queries: explaining a change (F), with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpilens.config import DIMENSIONS
from kpilens.operators import cube as C
from kpilens.operators import explain as X
from kpilens.plans.registry import kpi, periods, register
from kpilens.plans.sql_base import with_

ORACLE: dict[str, str] = {}


# ---------------------------------------------------------------- F1
@register("decompose")
def decompose(spark, d):
    """F1 (R12): last month against the previous month."""
    p = periods(spark, d)
    return X.decompose(kpi(spark, d).monthly, p["previous_month"], p["last_month"])


def _totals(flag: str, alias: str) -> str:
    return f"""{alias} AS (SELECT SUM(revenue) AS revenue, SUM(orders) AS orders,
       SUM(revenue) / NULLIF(SUM(orders), 0) AS aov, string_agg(month, ',' ORDER BY month) AS months
     FROM monthly JOIN per USING (month) WHERE per.{flag})"""


ORACLE["decompose"] = with_("monthly", "per", extra=_totals("prev1", "a") + ",\n" + _totals("cur1", "b")) + """
SELECT a.months AS prev, b.months AS cur, ROUND(a.revenue, 6) AS revenue_prev, ROUND(b.revenue, 6) AS revenue_cur,
       ROUND(b.revenue - a.revenue, 6) AS delta, ROUND((b.revenue - a.revenue) / NULLIF(a.revenue, 0), 6) AS delta_pct,
       ROUND((b.orders - a.orders) * a.aov, 6) AS volume_effect, ROUND(b.orders * (b.aov - a.aov), 6) AS aov_effect,
       ROUND(CASE WHEN b.revenue - a.revenue <> 0 THEN (b.orders - a.orders) * a.aov / (b.revenue - a.revenue) END, 6)
           AS volume_share,
       ROUND(CASE WHEN b.revenue - a.revenue <> 0 THEN b.orders * (b.aov - a.aov) / (b.revenue - a.revenue) END, 6)
           AS aov_share
FROM a CROSS JOIN b"""


# ---------------------------------------------------------------- F2-F4
@register("mom_zscore")
def mom_zscore(spark, d):
    """F2 (R10): every month's MoM z-score against its own trailing 24 months."""
    return X.zscore_table(kpi(spark, d).monthly)


_Z = """
z AS (SELECT month, mom,
        COUNT(mom) OVER w AS history, AVG(mom) OVER w AS hist_mean, STDDEV_SAMP(mom) OVER w AS hist_sd
      FROM monthly WINDOW w AS (ORDER BY month ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))"""

ORACLE["mom_zscore"] = with_("monthly", extra=_Z) + """
SELECT month, ROUND(mom, 6) AS mom, history, ROUND(hist_mean, 6) AS hist_mean, ROUND(hist_sd, 6) AS hist_sd,
       ROUND(CASE WHEN history >= 6 AND hist_sd <> 0 THEN (mom - hist_mean) / hist_sd END, 6) AS zscore,
       COALESCE(history >= 6 AND (ABS((mom - hist_mean) / NULLIF(hist_sd, 0)) >= 2.0
                                  OR (hist_sd = 0 AND mom <> hist_mean)), false) AS unusual
FROM z"""


@register("mom_zscore_window")
def mom_zscore_window(spark, d):
    """the last 3 months judged against ONE baseline (24 months before the first)."""
    return X.zscore_window(kpi(spark, d).monthly, periods(spark, d)["last_3_months"])


ORACLE["mom_zscore_window"] = with_("monthly", "per", extra="""
b AS (SELECT COUNT(m.mom) AS history, AVG(m.mom) AS hist_mean, STDDEV_SAMP(m.mom) AS hist_sd
      FROM monthly m JOIN per USING (month)
      WHERE per.idx < (SELECT MIN(idx) FROM per WHERE cur3) AND per.idx >= (SELECT MIN(idx) FROM per WHERE cur3) - 24)""") + """
SELECT m.month, ROUND(m.mom, 6) AS mom, b.history, ROUND(b.hist_mean, 6) AS hist_mean, ROUND(b.hist_sd, 6) AS hist_sd,
       ROUND(CASE WHEN b.history >= 6 AND b.hist_sd <> 0 THEN (m.mom - b.hist_mean) / b.hist_sd END, 6) AS zscore,
       COALESCE(b.history >= 6 AND (ABS((m.mom - b.hist_mean) / NULLIF(b.hist_sd, 0)) >= 2.0
                                    OR (b.hist_sd = 0 AND m.mom <> b.hist_mean)), false) AS unusual,
       (SELECT month FROM per WHERE cur3 ORDER BY month LIMIT 1) AS before
FROM monthly m JOIN per USING (month) CROSS JOIN b WHERE per.cur3"""


@register("unusual_months")
def unusual_months(spark, d):
    """months whose |z| >= 2."""
    return X.unusual_months(kpi(spark, d).monthly)


ORACLE["unusual_months"] = with_("monthly", extra=_Z) + """
SELECT month, ROUND(mom, 6) AS mom,
       ROUND(CASE WHEN history >= 6 AND hist_sd <> 0 THEN (mom - hist_mean) / hist_sd END, 6) AS zscore
FROM z WHERE COALESCE(history >= 6 AND (ABS((mom - hist_mean) / NULLIF(hist_sd, 0)) >= 2.0
                                        OR (hist_sd = 0 AND mom <> hist_mean)), false)"""


# ---------------------------------------------------------------- F5-F10
def contrib_ctes(dims, pf: str, cf: str, col: str = "sale_price", measure: str = "revenue", sfx: str = "") -> str:
    """SQL twin of contribution_all: UNION ALL of per-dimension group-bys."""
    parts = "\n  UNION ALL\n".join(
        f"""  SELECT '{dm}' AS dimension, {dm} AS segment,
         SUM(CASE WHEN per.{pf} THEN {col} ELSE 0 END) AS prev_d, SUM(CASE WHEN per.{cf} THEN {col} ELSE 0 END) AS cur_d
  FROM fact JOIN per USING (month) WHERE per.{pf} OR per.{cf} GROUP BY 1, 2""" for dm in dims)
    return f"""seg{sfx} AS (
{parts}),
c1{sfx} AS (SELECT dimension, segment, prev_d, cur_d, cur_d - prev_d AS delta_d,
              SUM(cur_d - prev_d) OVER (PARTITION BY dimension) AS tot_delta,
              SUM(prev_d) OVER (PARTITION BY dimension) AS tot_prev FROM seg{sfx}),
c2{sfx} AS (SELECT dimension, segment, '{measure}' AS measure, CAST(prev_d AS DOUBLE) AS prev, CAST(cur_d AS DOUBLE) AS cur,
              CAST(delta_d AS DOUBLE) AS delta,
              CASE WHEN tot_delta <> 0 THEN CAST(delta_d AS DOUBLE) / CAST(tot_delta AS DOUBLE) END AS share_of_change,
              CASE WHEN tot_prev <> 0 THEN CAST(prev_d AS DOUBLE) / CAST(tot_prev AS DOUBLE) END AS share_of_base
       FROM c1{sfx}),
contrib{sfx} AS (SELECT *, CASE WHEN share_of_base <> 0 THEN share_of_change / share_of_base END AS lift,
              COALESCE(share_of_base = 0 AND share_of_change <> 0, false) AS is_new_segment,
              ROW_NUMBER() OVER (PARTITION BY dimension ORDER BY ABS(delta) DESC, segment) AS rank
       FROM c2{sfx})"""


CONTRIB_OUT = """dimension, segment, measure, ROUND(prev, 6) AS prev, ROUND(cur, 6) AS cur, ROUND(delta, 6) AS delta,
       ROUND(share_of_change, 6) AS share_of_change, ROUND(share_of_base, 6) AS share_of_base,
       ROUND(lift, 6) AS lift, is_new_segment, rank"""


def _contrib_query(dim: str):
    def q(spark, d):
        p = periods(spark, d)
        return C.contribution(kpi(spark, d).cube, dim, p["previous_month"], p["last_month"])
    q.__doc__ = f"F5: contribution by {dim}, last month against the previous month."
    return q


for _dim in DIMENSIONS:
    register(f"contribution_{_dim}")(_contrib_query(_dim))
    ORACLE[f"contribution_{_dim}"] = with_("fact", "per", extra=contrib_ctes((_dim,), "prev1", "cur1")) + \
        f"SELECT {CONTRIB_OUT} FROM contrib"


@register("contribution_net")
def contribution_net(spark, d):
    """contribution of net revenue by distribution centre."""
    p = periods(spark, d)
    return C.contribution(kpi(spark, d).cube, "dist_center", p["previous_month"], p["last_month"], "net_revenue")


ORACLE["contribution_net"] = with_("fact", "per", extra=contrib_ctes(
    ("dist_center",), "prev1", "cur1", "net_sale_price", "net_revenue")) + f"SELECT {CONTRIB_OUT} FROM contrib"


@register("contribution_all")
def contribution_all(spark, d):
    """every dimension in one pass (last month against the previous one)."""
    p = periods(spark, d)
    return C.contribution_all(kpi(spark, d).cube, p["previous_month"], p["last_month"])


ORACLE["contribution_all"] = with_("fact", "per", extra=contrib_ctes(DIMENSIONS, "prev1", "cur1")) + \
    f"SELECT {CONTRIB_OUT} FROM contrib"


@register("contribution_top5")
def contribution_top5(spark, d):
    """top 5 segments per dimension, last 3 months against the 3 before."""
    p = periods(spark, d)
    return X.contribution_top(C.contribution_all(kpi(spark, d).cube, p["previous_3_months"], p["last_3_months"]), 5)


ORACLE["contribution_top5"] = with_("fact", "per", extra=contrib_ctes(DIMENSIONS, "prev3", "cur3")) + \
    f"SELECT {CONTRIB_OUT} FROM contrib WHERE rank <= 5"


DIM_POS = " ".join(f"WHEN '{dm}' THEN {i}" for i, dm in enumerate(DIMENSIONS))


def drivers_ctes(pf: str, cf: str, col: str, measure: str, sfx: str = "") -> str:
    """contrib{sfx}, guard{sfx} and drv{sfx} (the ranked driver rows)."""
    mcol = "revenue" if measure == "revenue" else "net_revenue"
    return contrib_ctes(DIMENSIONS, pf, cf, col, measure, sfx) + f""",
guard{sfx} AS (SELECT CASE WHEN a <> 0 THEN ABS(b - a) / a >= 0.02 ELSE false END AS look
          FROM (SELECT SUM(CASE WHEN per.{pf} THEN {mcol} END) AS a, SUM(CASE WHEN per.{cf} THEN {mcol} END) AS b
                FROM monthly JOIN per USING (month)) t),
drv{sfx} AS (SELECT *, ROW_NUMBER() OVER (ORDER BY ABS(share_of_change) DESC, CASE dimension {DIM_POS} END, rank)
                  AS driver_rank
         FROM contrib{sfx} CROSS JOIN guard{sfx}
         WHERE guard{sfx}.look AND ABS(share_of_change) >= 0.15 AND (is_new_segment OR ABS(lift - 1) >= 0.5))"""


def drivers_sql(pf: str, cf: str, col: str, measure: str) -> str:
    return with_("fact", "per", "monthly", extra=drivers_ctes(pf, cf, col, measure)) + """
SELECT dimension, segment, measure, ROUND(delta, 6) AS delta, ROUND(share_of_change, 6) AS share_of_change,
       ROUND(share_of_base, 6) AS share_of_base, ROUND(lift, 6) AS lift, is_new_segment, driver_rank
FROM drv"""


def _drivers_query(pk: str, ck: str, measure: str, doc: str):
    def q(spark, d):
        k, p = kpi(spark, d), periods(spark, d)
        return C.find_drivers(k.cube, p[pk], p[ck], DIMENSIONS, measure)
    q.__doc__ = doc
    return q


register("find_drivers")(_drivers_query("previous_month", "last_month", "revenue",
                                        "F8 (R11): drivers of the last month's gross change."))
ORACLE["find_drivers"] = drivers_sql("prev1", "cur1", "sale_price", "revenue")
register("find_drivers_net")(_drivers_query("previous_month", "last_month", "net_revenue",
                                            "F9: drivers of the last month's net change."))
ORACLE["find_drivers_net"] = drivers_sql("prev1", "cur1", "net_sale_price", "net_revenue")
register("find_drivers_3m")(_drivers_query("previous_3_months", "last_3_months", "revenue",
                                           "F8 over the last 3 months against the 3 before."))
ORACLE["find_drivers_3m"] = drivers_sql("prev3", "cur3", "sale_price", "revenue")
register("find_drivers_3m_net")(_drivers_query("previous_3_months", "last_3_months", "net_revenue",
                                               "F9 over the last 3 months against the 3 before."))
ORACLE["find_drivers_3m_net"] = drivers_sql("prev3", "cur3", "net_sale_price", "net_revenue")


# ---------------------------------------------------------------- F11 / F12
@register("leakage_alert")
def leakage_alert(spark, d):
    """the last month's returned share against mean + 3 sd of the 12 months before."""
    return X.leakage_alert(kpi(spark, d).leakage_monthly())


ORACLE["leakage_alert"] = with_("leak", extra="""
h AS (SELECT month, returned, AVG(returned) OVER w AS hist_mean, STDDEV_SAMP(returned) OVER w AS hist_sd,
             COUNT(returned) OVER w AS history
      FROM leak WINDOW w AS (ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))""") + """
SELECT month, ROUND(returned, 6) AS returned_share, ROUND(hist_mean, 6) AS hist_mean, ROUND(hist_sd, 6) AS hist_sd,
       history, ROUND(CASE WHEN hist_sd <> 0 THEN (returned - hist_mean) / hist_sd END, 6) AS sd_above,
       COALESCE(returned > hist_mean + 3.0 * hist_sd, false) AS alert
FROM h ORDER BY month DESC LIMIT 1"""


@register("leakage_outlier_segments")
def leakage_outlier_segments(spark, d):
    """distribution centres whose returned share >= 2 x the others' median (last month)."""
    k, p = kpi(spark, d), periods(spark, d)
    return X.outlier_segments(C.leakage_by_dim(k.cube, p["last_month"][0], "dist_center"))


ORACLE["leakage_outlier_segments"] = with_("fact", "per", extra="""
lk AS (SELECT dist_center AS segment,
              CAST(SUM(CASE WHEN order_status = 'Returned' THEN sale_price ELSE 0 END) AS DOUBLE)
                / NULLIF(CAST(SUM(sale_price) AS DOUBLE), 0) AS returned
       FROM fact JOIN per USING (month) WHERE per.cur1 GROUP BY 1)""") + """
SELECT a.segment, ROUND(a.returned, 6) AS returned,
       ROUND((SELECT MEDIAN(b.returned) FROM lk b WHERE b.segment <> a.segment), 6) AS others_median,
       COALESCE(a.returned >= 2.0 * (SELECT MEDIAN(b.returned) FROM lk b WHERE b.segment <> a.segment), false)
           AS flagged
FROM lk a"""


# ---------------------------------------------------------------- F13 / F14
@register("change_report")
def change_report_q(spark, d):
    """F13 naive: why did revenue change last month?"""
    from kpilens.plans.report import change_report
    return change_report(spark, d, thorough=False)


@register("change_report_thorough")
def change_report_thorough_q(spark, d):
    """F13 thorough: + net drivers, returned share against its history, centres."""
    from kpilens.plans.report import change_report
    return change_report(spark, d, thorough=True)


@register("truth_document")
def truth_document_q(spark, d):
    """The truth document as JSON (no SQL twin: rows-only check)."""
    from kpilens.plans.report import truth_document
    return truth_document(spark, d)


@register("truth_fields")
def truth_fields(spark, d):
    """Fields of the frozen truth document, read back with its schema (the document's rounding)."""
    from kpilens.plans.report import frozen_truth
    lm, l3 = "last_month.", "last_3_months."
    return frozen_truth(spark, d).select(
        F.col("defaults.last_month").alias("last_month"), F.array_join("defaults.last_3_months", ",").alias("last_3_months"),
        F.col(lm + "headline.revenue").alias("revenue"), F.col(lm + "headline.net_revenue").alias("net_revenue"),
        F.col(lm + "headline.orders").alias("orders"), F.col(lm + "vs_previous_month.delta").alias("delta"),
        F.col(lm + "vs_previous_month.delta_pct").alias("delta_pct"), F.col(lm + "vs_previous_month.volume_share").alias("volume_share"),
        F.col(lm + "zscore").alias("zscore"), F.col(lm + "unusual").alias("unusual"),
        F.array_join(F.transform(F.col(lm + "drivers"), lambda x: F.concat(x["dimension"], F.lit("="), x["segment"])), "|").alias("drivers"),
        F.array_join(F.transform(F.col(lm + "net_drivers"), lambda x: F.concat(x["dimension"], F.lit("="), x["segment"])), "|").alias("net_drivers"),
        F.col(lm + "leakage.cancelled").alias("cancelled"), F.col(lm + "leakage.returned").alias("returned"),
        F.size(lm + "contribution_top5").alias("top5_rows"), F.size(lm + "leakage_by_dist_center").alias("centres"),
        F.col(l3 + "headline.revenue").alias("revenue_3m"), F.col(l3 + "headline.aov").alias("aov_3m"),
        F.array_join(l3 + "unusual_months", ",").alias("unusual_months"),
        F.col("known_wrong_answers.revenue_last_month_fanout").alias("fanout"),
        F.col("known_wrong_answers.aov_last_3_months_as_mean_of_monthly").alias("mean_aov"))


@register("truth_monthly")
def truth_monthly(spark, d):
    """The twelve months of the frozen truth document."""
    from kpilens.plans.report import frozen_truth
    return frozen_truth(spark, d).select(F.inline("monthly"))


_REPORT_CTES = drivers_ctes("prev1", "cur1", "sale_price", "revenue") + ",\n" + _totals("prev1", "a") + ",\n" + \
    _totals("cur1", "b") + """,
zb AS (SELECT COUNT(m.mom) AS history, AVG(m.mom) AS hist_mean, STDDEV_SAMP(m.mom) AS hist_sd
       FROM monthly m JOIN per USING (month)
       WHERE per.idx < (SELECT idx FROM per WHERE cur1) AND per.idx >= (SELECT idx FROM per WHERE cur1) - 24),
zc AS (SELECT m.mom, zb.* FROM monthly m JOIN per USING (month) CROSS JOIN zb WHERE per.cur1),
head AS (
  SELECT (SELECT month FROM per WHERE cur1) AS period, (SELECT month FROM per WHERE prev1) AS previous,
         'revenue' AS measure, ROUND(b.revenue, 6) AS value, ROUND(a.revenue, 6) AS value_previous,
         ROUND((b.revenue - a.revenue) / NULLIF(a.revenue, 0), 6) AS change_pct,
         ROUND(CASE WHEN zc.history >= 6 AND zc.hist_sd <> 0 THEN (zc.mom - zc.hist_mean) / zc.hist_sd END, 6) AS zscore,
         COALESCE(zc.history >= 6 AND (ABS((zc.mom - zc.hist_mean) / NULLIF(zc.hist_sd, 0)) >= 2.0
                                       OR (zc.hist_sd = 0 AND zc.mom <> zc.hist_mean)), false) AS unusual,
         ROUND(CASE WHEN b.revenue - a.revenue <> 0 THEN (b.orders - a.orders) * a.aov / (b.revenue - a.revenue) END, 6)
             AS volume_share,
         ROUND(CASE WHEN b.revenue - a.revenue <> 0 THEN b.orders * (b.aov - a.aov) / (b.revenue - a.revenue) END, 6)
             AS aov_share
  FROM a CROSS JOIN b CROSS JOIN zc)"""

ORACLE["change_report"] = with_("fact", "per", "monthly", extra=_REPORT_CTES + """,
dt AS (SELECT 0 AS g, driver_rank AS o, dimension || '=' || segment || ' (' || measure || ')' AS txt FROM drv)""") + """
SELECT head.*, (SELECT COUNT(*) FROM dt) AS n_drivers,
       COALESCE((SELECT string_agg(txt, '|' ORDER BY g, o) FROM dt), '') AS drivers
FROM head"""

ORACLE["change_report_thorough"] = with_("fact", "per", "monthly", "leak", extra=_REPORT_CTES + ",\n" +
                                         drivers_ctes("prev1", "cur1", "net_sale_price", "net_revenue", "_n") + """,
lh AS (SELECT month, returned, AVG(returned) OVER w AS hist_mean, STDDEV_SAMP(returned) OVER w AS hist_sd
       FROM leak WINDOW w AS (ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)),
al AS (SELECT ROUND(returned, 6) AS returned_share, ROUND(hist_mean, 6) AS returned_hist_mean,
              ROUND(hist_sd, 6) AS returned_hist_sd, COALESCE(returned > hist_mean + 3.0 * hist_sd, false) AS returned_alert
       FROM lh ORDER BY month DESC LIMIT 1),
lk AS (SELECT dist_center AS segment, SUM(sale_price) AS rev,
              CAST(SUM(CASE WHEN order_status = 'Returned' THEN sale_price ELSE 0 END) AS DOUBLE)
                / NULLIF(CAST(SUM(sale_price) AS DOUBLE), 0) AS returned
       FROM fact JOIN per USING (month) WHERE per.cur1 GROUP BY 1),
lo AS (SELECT a.segment, ROW_NUMBER() OVER (ORDER BY a.rev DESC, a.segment) AS o,
              a.returned >= 2.0 * (SELECT MEDIAN(b.returned) FROM lk b WHERE b.segment <> a.segment) AS flagged
       FROM lk a),
dt AS (SELECT 0 AS g, driver_rank AS o, dimension || '=' || segment || ' (' || measure || ')' AS txt FROM drv
       UNION ALL
       SELECT 1, driver_rank, dimension || '=' || segment || ' (' || measure || ')' FROM drv_n
       UNION ALL
       SELECT 2, o, 'dist_center=' || segment || ' (returned_share)' FROM lo CROSS JOIN al
       WHERE lo.flagged AND al.returned_alert)""") + """
SELECT head.*, al.*, (SELECT COUNT(*) FROM dt) AS n_drivers,
       COALESCE((SELECT string_agg(txt, '|' ORDER BY g, o) FROM dt), '') AS drivers
FROM head CROSS JOIN al"""

ORACLE["truth_monthly"] = with_("monthly", "leak") + """
SELECT month, ROUND(revenue, 2) AS revenue, ROUND(net_revenue, 2) AS net_revenue, orders, items, ROUND(aov, 2) AS aov,
       ROUND(margin, 4) AS margin, ROUND(mom, 4) AS mom, ROUND(cancelled, 4) AS cancelled_share, ROUND(returned, 4) AS returned_share
FROM monthly LEFT JOIN leak USING (month) ORDER BY month DESC LIMIT 12"""

ORACLE["truth_fields"] = with_("fact", "per", "monthly", "leak", "o", "oi", extra=_REPORT_CTES + ",\n" +
                               drivers_ctes("prev1", "cur1", "net_sale_price", "net_revenue", "_n") + """,
z3b AS (SELECT COUNT(m.mom) AS history, AVG(m.mom) AS hist_mean, STDDEV_SAMP(m.mom) AS hist_sd
        FROM monthly m JOIN per USING (month)
        WHERE per.idx < (SELECT MIN(idx) FROM per WHERE cur3) AND per.idx >= (SELECT MIN(idx) FROM per WHERE cur3) - 24),
z3 AS (SELECT string_agg(m.month, ',' ORDER BY m.month) AS months FROM monthly m JOIN per USING (month) CROSS JOIN z3b
       WHERE per.cur3 AND history >= 6 AND (ABS((mom - hist_mean) / NULLIF(hist_sd, 0)) >= 2.0 OR (hist_sd = 0 AND mom <> hist_mean)))""") + """
SELECT head.period AS last_month, (SELECT string_agg(month, ',' ORDER BY month) FROM per WHERE cur3) AS last_3_months,
       ROUND(m.revenue, 6) AS revenue, ROUND(m.net_revenue, 6) AS net_revenue, m.orders,
       ROUND(b.revenue - a.revenue, 2) AS delta, ROUND((b.revenue - a.revenue) / NULLIF(a.revenue, 0), 4) AS delta_pct,
       ROUND(CASE WHEN b.revenue - a.revenue <> 0 THEN (b.orders - a.orders) * a.aov / (b.revenue - a.revenue) END, 4) AS volume_share,
       ROUND(CASE WHEN zc.history >= 6 AND zc.hist_sd <> 0 THEN (zc.mom - zc.hist_mean) / zc.hist_sd END, 2) AS zscore, head.unusual,
       COALESCE((SELECT string_agg(dimension || '=' || segment, '|' ORDER BY driver_rank) FROM drv), '') AS drivers,
       COALESCE((SELECT string_agg(dimension || '=' || segment, '|' ORDER BY driver_rank) FROM drv_n), '') AS net_drivers,
       ROUND(leak.cancelled, 4) AS cancelled, ROUND(leak.returned, 4) AS returned,
       (SELECT COUNT(*) FROM contrib WHERE rank <= 5) AS top5_rows,
       (SELECT COUNT(DISTINCT dist_center) FROM fact JOIN per USING (month) WHERE per.cur1) AS centres,
       (SELECT ROUND(SUM(revenue), 6) FROM monthly JOIN per USING (month) WHERE per.cur3) AS revenue_3m,
       (SELECT ROUND(SUM(revenue) / SUM(orders), 6) FROM monthly JOIN per USING (month) WHERE per.cur3) AS aov_3m,
       COALESCE((SELECT months FROM z3), '') AS unusual_months,
       (SELECT ROUND(CAST(SUM(oi.sale_price) AS DOUBLE), 2) FROM oi JOIN o ON o.order_id = oi.order_id JOIN oi oi2 ON oi2.order_id = oi.order_id
         WHERE strftime(o.created_at, '%Y-%m') = head.period) AS fanout,
       (SELECT ROUND(AVG(aov), 2) FROM monthly JOIN per USING (month) WHERE per.cur3) AS mean_aov
FROM head CROSS JOIN a CROSS JOIN b CROSS JOIN zc JOIN monthly m ON m.month = head.period LEFT JOIN leak ON leak.month = head.period"""
