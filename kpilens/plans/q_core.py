"""Registered queries: fact (C), calendar (D) and KPIs (E), with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpilens.config import UNKNOWN
from kpilens.functions.columns import money, month_range
from kpilens.operators import metrics as E
from kpilens.operators.fact import customer_type
from kpilens.plans.registry import kpi, periods, register
from kpilens.plans.sql_base import TODAY, r6, ts, with_

ORACLE: dict[str, str] = {}

FACT_COLS = ("order_id", "user_id", "sale_price", "month", "order_created_at", "order_status", "cost",
             "category", "brand", "department", "dist_center", "acq_source", "country", "customer_type",
             "profit", "lost", "net_sale_price", "item_created_at")


# ---------------------------------------------------------------- C
@register("fact_items")
def fact_items(spark, d):
    """The item-grain fact."""
    return kpi(spark, d).fact.select(*FACT_COLS)


ORACLE["fact_items"] = with_("fact") + f"""
SELECT order_id, user_id, {r6('sale_price')} AS sale_price, month, {ts('order_created_at')} AS order_created_at,
       order_status, {r6('cost')} AS cost, category, brand, department, dist_center, acq_source, country,
       customer_type, {r6('profit')} AS profit, lost, {r6('net_sale_price')} AS net_sale_price,
       {ts('item_created_at')} AS item_created_at
FROM fact"""


@register("unknown_segment")
def unknown_segment(spark, d):
    """C2 (R17): items and revenue that sit in the '(unknown)' segment of each dimension."""
    f = kpi(spark, d).fact
    dims = ("category", "brand", "department", "dist_center", "acq_source", "country")
    pairs = F.array(*[F.struct(F.lit(x).alias("dimension"), F.col(x).alias("segment")) for x in dims])
    return (f.select(F.inline(pairs), "sale_price").filter(F.col("segment") == UNKNOWN)
             .groupBy("dimension").agg(F.count(F.lit(1)).alias("items"),
                                       money(F.sum("sale_price")).alias("revenue")))


ORACLE["unknown_segment"] = with_("fact") + """
SELECT dimension, COUNT(*) AS items, ROUND(CAST(SUM(sale_price) AS DOUBLE), 6) AS revenue FROM (
  SELECT 'category' AS dimension, category AS segment, sale_price FROM fact UNION ALL
  SELECT 'brand', brand, sale_price FROM fact UNION ALL
  SELECT 'department', department, sale_price FROM fact UNION ALL
  SELECT 'dist_center', dist_center, sale_price FROM fact UNION ALL
  SELECT 'acq_source', acq_source, sale_price FROM fact UNION ALL
  SELECT 'country', country, sale_price FROM fact) t
WHERE segment = '(unknown)' GROUP BY dimension"""


@register("customer_type")
def customer_type_q(spark, d):
    """C4 (R13) at order grain, scope = orders with items."""
    return customer_type(kpi(spark, d).star, "with_items")


ORACLE["customer_type"] = with_("fo") + f"""
SELECT o.order_id, o.user_id, {ts('o.created_at')} AS created_at,
       CASE WHEN date_trunc('second', o.created_at) = fo.first_at THEN 'new' ELSE 'returning' END AS customer_type
FROM o JOIN fo ON fo.user_id = o.user_id
WHERE o.order_id IN (SELECT order_id FROM oi)"""


# ---------------------------------------------------------------- D
@register("complete_months")
def complete_months(spark, d):
    """Every complete month with its position."""
    return E.complete_months(kpi(spark, d).monthly)


ORACLE["complete_months"] = with_("months") + "SELECT month, idx FROM months"


@register("last_complete_months")
def last_complete_months(spark, d):
    """D2 (R8): the last 3 complete months."""
    return E.complete_months(kpi(spark, d).monthly).orderBy(F.desc("month")).limit(3)


ORACLE["last_complete_months"] = with_("months") + "SELECT month, idx FROM months ORDER BY month DESC LIMIT 3"


@register("previous_period")
def previous_period(spark, d):
    """D3 (R9): the 3 months before the last 3, by position."""
    p = periods(spark, d)
    rows = [("last_3_months", m) for m in p["last_3_months"]] + \
           [("previous_3_months", m) for m in p["previous_3_months"]]
    sel = spark.createDataFrame(rows, "period string, month string")
    return E.complete_months(kpi(spark, d).monthly).join(F.broadcast(sel), "month") \
            .select("period", "month", "idx")


ORACLE["previous_period"] = with_("per") + """
SELECT CASE WHEN cur3 THEN 'last_3_months' ELSE 'previous_3_months' END AS period, month, idx
FROM per WHERE cur3 OR prev3"""


@register("default_periods")
def default_periods(spark, d):
    """Last month, previous month, last 3, previous 3."""
    p = periods(spark, d)
    rows = [(name, m) for name, ms in p.items() for m in ms]
    sel = spark.createDataFrame(rows, "period string, month string")
    return E.complete_months(kpi(spark, d).monthly).join(F.broadcast(sel), "month") \
            .select("period", "month", "idx")


ORACLE["default_periods"] = with_("per") + """
SELECT 'last_month' AS period, month, idx FROM per WHERE cur1 UNION ALL
SELECT 'previous_month', month, idx FROM per WHERE prev1 UNION ALL
SELECT 'last_3_months', month, idx FROM per WHERE cur3 UNION ALL
SELECT 'previous_3_months', month, idx FROM per WHERE prev3"""


@register("month_range_filter")
def month_range_filter(spark, d):
    """The last month selected with a half-open timestamp range (pushed to the scan)."""
    k = kpi(spark, d)
    m = periods(spark, d)["last_month"][0]
    o = k.star.orders.filter(month_range("created_at", m)).select("order_id")
    return (k.star.order_items.join(o, "order_id")
            .agg(F.countDistinct("order_id").alias("orders"), F.count(F.lit(1)).alias("items"),
                 money(F.sum("sale_price")).alias("revenue"))
            .select(F.lit(m).alias("month"), "*"))


ORACLE["month_range_filter"] = with_("per", extra="""
bounds AS (SELECT month, CAST(month || '-01' AS TIMESTAMP) AS a,
                  CAST(month || '-01' AS TIMESTAMP) + INTERVAL 1 MONTH AS b FROM per WHERE cur1)""") + """
SELECT bounds.month, COUNT(DISTINCT oi.order_id) AS orders, COUNT(*) AS items,
       ROUND(CAST(SUM(oi.sale_price) AS DOUBLE), 6) AS revenue
FROM oi JOIN o ON o.order_id = oi.order_id JOIN bounds ON o.created_at >= bounds.a AND o.created_at < bounds.b
GROUP BY bounds.month"""


# ---------------------------------------------------------------- E
MONTHLY_SQL = """month, ROUND(revenue, 6) AS revenue, ROUND(net_revenue, 6) AS net_revenue, orders, items,
       ROUND(profit, 6) AS profit, ROUND(aov, 6) AS aov, ROUND(items_per_order, 6) AS items_per_order,
       ROUND(margin, 6) AS margin, ROUND(mom, 6) AS mom"""


@register("monthly_kpis")
def monthly_kpis(spark, d):
    """KPIs of every complete month."""
    return kpi(spark, d).monthly.select("month", "revenue", "net_revenue", "orders", "items", "profit", "aov",
                                        "items_per_order", "margin", "mom")


ORACLE["monthly_kpis"] = with_("monthly") + f"SELECT {MONTHLY_SQL} FROM monthly"


@register("monthly_mom")
def monthly_mom(spark, d):
    """E3 (R9): MoM against the previous row."""
    return kpi(spark, d).monthly.select("month", "revenue", "mom")


ORACLE["monthly_mom"] = with_("monthly") + "SELECT month, ROUND(revenue, 6) AS revenue, ROUND(mom, 6) AS mom FROM monthly"


@register("kpi_point")
def kpi_point(spark, d):
    """The eight point values of the last complete month."""
    return E.kpi_point(kpi(spark, d).monthly, periods(spark, d)["last_month"][0])


ORACLE["kpi_point"] = with_("monthly", "per") + """
SELECT m.month, ROUND(revenue, 6) AS revenue, ROUND(net_revenue, 6) AS net_revenue, orders, items,
       ROUND(aov, 6) AS aov, ROUND(profit, 6) AS profit, ROUND(margin, 6) AS margin, ROUND(mom, 6) AS mom
FROM monthly m JOIN per USING (month) WHERE per.cur1"""


@register("period_totals")
def period_totals(spark, d):
    """E5 (R6): totals of the last 3 months; aov and margin as ratios of totals."""
    return E.period_totals(kpi(spark, d).monthly, periods(spark, d)["last_3_months"])


def _period_sql(flag: str) -> str:
    return f"""
SELECT ROUND(SUM(revenue), 6) AS revenue, ROUND(SUM(net_revenue), 6) AS net_revenue, SUM(orders) AS orders,
       SUM(items) AS items, ROUND(SUM(profit), 6) AS profit,
       ROUND(SUM(revenue) / NULLIF(SUM(orders), 0), 6) AS aov,
       ROUND(SUM(profit) / NULLIF(SUM(revenue), 0), 6) AS margin,
       string_agg(month, ',' ORDER BY month) AS months
FROM monthly JOIN per USING (month) WHERE per.{flag}"""


ORACLE["period_totals"] = with_("monthly", "per") + _period_sql("cur3")


@register("monthly_last12")
def monthly_last12(spark, d):
    """The last 12 complete months with the cancelled / returned order shares."""
    k = kpi(spark, d)
    return (k.monthly_with_leakage().orderBy(F.desc("month")).limit(12)
             .select("month", "revenue", "net_revenue", "orders", "items", "aov", "margin", "mom",
                     F.col("cancelled").alias("cancelled_share"), F.col("returned").alias("returned_share")))


ORACLE["monthly_last12"] = with_("monthly", "leak") + """
SELECT m.month, ROUND(revenue, 6) AS revenue, ROUND(net_revenue, 6) AS net_revenue, orders, items,
       ROUND(aov, 6) AS aov, ROUND(margin, 6) AS margin, ROUND(mom, 6) AS mom,
       ROUND(l.cancelled, 6) AS cancelled_share, ROUND(l.returned, 6) AS returned_share
FROM monthly m LEFT JOIN leak l USING (month) ORDER BY m.month DESC LIMIT 12"""


@register("total_before_today")
def total_before_today(spark, d):
    """Revenue of every order created before today."""
    return E.total_before_today(kpi(spark, d).star)


ORACLE["total_before_today"] = with_("o", "oi") + f"""
SELECT ROUND(CAST(SUM(oi.sale_price) AS DOUBLE), 6) AS revenue
FROM oi JOIN o ON o.order_id = oi.order_id WHERE o.created_at < TIMESTAMP '{TODAY} 00:00:00'"""


@register("monthly_core_sql")
def monthly_core_sql(spark, d):
    """The SQL path over all months."""
    return E.monthly_core_sql(kpi(spark, d).star)


ORACLE["monthly_core_sql"] = with_("o", "oi", "p") + """
SELECT strftime(o.created_at, '%Y-%m') AS month, ROUND(CAST(SUM(oi.sale_price) AS DOUBLE), 6) AS revenue,
       ROUND(CAST(SUM(CASE WHEN o.status NOT IN ('Cancelled', 'Returned') THEN oi.sale_price ELSE 0 END)
                  AS DOUBLE), 6) AS net_revenue,
       COUNT(DISTINCT oi.order_id) AS orders, COUNT(*) AS items,
       ROUND(CAST(SUM(oi.sale_price - p.cost) AS DOUBLE), 6) AS profit
FROM oi JOIN o ON o.order_id = oi.order_id JOIN p ON p.id = oi.product_id
GROUP BY 1"""


@register("revenue_by_dim")
def revenue_by_dim(spark, d):
    """E9 (A3): segment revenue of the last month for 6 dimensions, SQL path."""
    return E.revenue_by_dim_sql(kpi(spark, d).star, periods(spark, d)["last_month"][0])


def _by_dim_sql(expr: str, name: str) -> str:
    return f"""SELECT '{name}' AS dimension, COALESCE({expr}, '(unknown)') AS segment,
       ROUND(CAST(SUM(oi.sale_price) AS DOUBLE), 6) AS revenue
FROM oi JOIN o ON o.order_id = oi.order_id JOIN p ON p.id = oi.product_id JOIN u ON u.id = o.user_id
     JOIN dc ON dc.id = oi.supplier_id JOIN per ON per.month = strftime(o.created_at, '%Y-%m')
WHERE per.cur1 GROUP BY 1, 2"""


ORACLE["revenue_by_dim"] = with_("o", "oi", "p", "u", "dc", "per") + "\nUNION ALL\n".join(
    _by_dim_sql(e, n) for n, e in E.DIM_SQL.items())


@register("revenue_by_customer_type")
def revenue_by_customer_type(spark, d):
    """New vs returning revenue of the last month, first order over ALL orders."""
    return E.revenue_by_customer_type_sql(kpi(spark, d).star, periods(spark, d)["last_month"][0])


ORACLE["revenue_by_customer_type"] = with_("o", "oi", "per", extra="""
f AS (SELECT user_id, MIN(date_trunc('second', created_at)) AS first_at FROM o GROUP BY user_id)""") + """
SELECT CASE WHEN date_trunc('second', o.created_at) = f.first_at THEN 'new' ELSE 'returning' END AS segment,
       ROUND(CAST(SUM(oi.sale_price) AS DOUBLE), 6) AS revenue
FROM oi JOIN o ON o.order_id = oi.order_id JOIN f ON f.user_id = o.user_id
     JOIN per ON per.month = strftime(o.created_at, '%Y-%m')
WHERE per.cur1 GROUP BY 1"""


@register("trend_last8")
def trend_last8(spark, d):
    """The last 8 complete months, percentages."""
    return E.trend_last(kpi(spark, d).monthly, 8)


ORACLE["trend_last8"] = with_("monthly") + """
SELECT month, ROUND(revenue, 6) AS revenue, ROUND(mom * 100, 6) AS mom_pct, ROUND(net_revenue, 6) AS net_revenue,
       orders, ROUND(aov, 6) AS aov, ROUND(items_per_order, 6) AS items_per_order,
       ROUND(margin * 100, 6) AS margin_pct
FROM monthly ORDER BY month DESC LIMIT 8"""


@register("trap_item_month")
def trap_item_month(spark, d):
    """E12 (known wrong, R2): last month's revenue by item month."""
    return E.trap_item_month(kpi(spark, d).star, periods(spark, d)["last_month"][0])


ORACLE["trap_item_month"] = with_("oi", "per") + """
SELECT ROUND(CAST(SUM(sale_price) AS DOUBLE), 6) AS revenue
FROM oi WHERE strftime(created_at, '%Y-%m') = (SELECT month FROM per WHERE cur1)"""


@register("trap_fanout")
def trap_fanout(spark, d):
    """E13 (known wrong, R16): the fan-out total of the last month."""
    return E.trap_fanout(kpi(spark, d).star, periods(spark, d)["last_month"][0])


ORACLE["trap_fanout"] = with_("o", "oi", "per") + """
SELECT ROUND(CAST(SUM(oi.sale_price) AS DOUBLE), 6) AS revenue
FROM oi JOIN o ON o.order_id = oi.order_id JOIN oi oi2 ON oi2.order_id = oi.order_id
WHERE strftime(o.created_at, '%Y-%m') = (SELECT month FROM per WHERE cur1)"""


@register("known_wrong_answers")
def known_wrong_answers(spark, d):
    """The four recorded wrong answers of the last month / last 3 months."""
    k, p = kpi(spark, d), periods(spark, d)
    m = p["last_month"][0]
    item = E.trap_item_month(k.star, m).select(F.col("revenue").alias("revenue_last_month_by_item_month"))
    fan = E.trap_fanout(k.star, m).select(F.col("revenue").alias("revenue_last_month_fanout"))
    net = k.monthly.filter(F.col("month") == m).select(
        F.col("net_revenue").alias("revenue_last_month_net_instead_of_gross"))
    aov = (k.monthly.filter(F.col("month").isin(p["last_3_months"]))
            .agg(F.avg("aov").alias("aov_last_3_months_as_mean_of_monthly")))
    return item.crossJoin(net).crossJoin(fan).crossJoin(aov)      # four one-row frames


ORACLE["known_wrong_answers"] = with_("monthly", "per") + """
SELECT
  (SELECT ROUND(CAST(SUM(sale_price) AS DOUBLE), 6) FROM oi
    WHERE strftime(created_at, '%Y-%m') = (SELECT month FROM per WHERE cur1)) AS revenue_last_month_by_item_month,
  (SELECT ROUND(net_revenue, 6) FROM monthly JOIN per USING (month) WHERE cur1)
      AS revenue_last_month_net_instead_of_gross,
  (SELECT ROUND(CAST(SUM(oi.sale_price) AS DOUBLE), 6)
     FROM oi JOIN o ON o.order_id = oi.order_id JOIN oi oi2 ON oi2.order_id = oi.order_id
    WHERE strftime(o.created_at, '%Y-%m') = (SELECT month FROM per WHERE cur1)) AS revenue_last_month_fanout,
  (SELECT ROUND(AVG(aov), 6) FROM monthly JOIN per USING (month) WHERE cur3) AS aov_last_3_months_as_mean_of_monthly"""


@register("margin_by_category")
def margin_by_category(spark, d):
    """Category margins of the last month, 4 lowest and 4 highest flagged."""
    return E.margin_by_category(kpi(spark, d).fact, periods(spark, d)["last_month"][0])


ORACLE["margin_by_category"] = with_("fact", "per", extra="""
g AS (SELECT category, SUM(sale_price) AS rev, SUM(profit) AS prof
      FROM fact JOIN per USING (month) WHERE per.cur1 GROUP BY category),
h AS (SELECT category, CAST(rev AS DOUBLE) AS revenue, CAST(prof AS DOUBLE) AS profit,
             CAST(prof AS DOUBLE) / NULLIF(CAST(rev AS DOUBLE), 0) AS margin,
             CAST(rev AS DOUBLE) / NULLIF(CAST(SUM(rev) OVER () AS DOUBLE), 0) AS rev_share FROM g)""") + """
SELECT category, ROUND(revenue, 6) AS revenue, ROUND(profit, 6) AS profit, ROUND(margin, 6) AS margin,
       ROUND(rev_share, 6) AS rev_share,
       ROW_NUMBER() OVER (ORDER BY margin ASC, category) AS lowest_rank,
       ROW_NUMBER() OVER (ORDER BY margin DESC, category) AS highest_rank,
       ROW_NUMBER() OVER (ORDER BY margin ASC, category) <= 4 AS is_lowest,
       ROW_NUMBER() OVER (ORDER BY margin DESC, category) <= 4 AS is_highest
FROM h"""


@register("monthly_tail_item_month")
def monthly_tail_item_month(spark, d):
    """The last 8 item months."""
    return E.monthly_tail_item_month(kpi(spark, d).star, 8)


ORACLE["monthly_tail_item_month"] = with_("oi") + """
SELECT strftime(created_at, '%Y-%m') AS month, COUNT(*) AS items, ROUND(CAST(SUM(sale_price) AS DOUBLE), 6) AS revenue
FROM oi GROUP BY 1 ORDER BY 1 DESC LIMIT 8"""



@register("synonym_lookup")
def synonym_lookup(spark, d):
    """The KPI terms (and the rule each maps to) that every answer mentions
    (case-insensitive containment; the term list is a projection constant, not a join)."""
    from kpilens.config import SYNONYMS
    from kpilens.plans.q_grading import answers
    terms = F.array(*[F.struct(F.lit(t).alias("term"), F.lit(m).alias("meaning")) for t, m in SYNONYMS])
    hit = F.filter(terms, lambda s: F.instr(F.lower(F.col("output")), s["term"]) > 0)
    return answers(spark, d).select("conv_id", "turn", F.inline(hit))


def _syn_sql() -> str:
    from kpilens.config import SYNONYMS
    from kpilens.plans.q_grading import BASE
    lst = ", ".join(f"{{'term': '{t}', 'meaning': '{m}'}}" for t, m in SYNONYMS)
    return BASE + f"""
SELECT conv_id, turn, s.term, s.meaning FROM (
  SELECT conv_id, turn, UNNEST(list_filter([{lst}], lambda x: instr(lower(output), x.term) > 0)) AS s
  FROM ans) t"""


ORACLE["synonym_lookup"] = _syn_sql()
