"""Registered queries: data contracts (I1-I11), with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpilens.config import DIMENSIONS, Rules
from kpilens.operators import cube as C
from kpilens.operators import explain as X
from kpilens.operators import metrics as E
from kpilens.operators import reconcile as I
from kpilens.operators import whatif as J
from kpilens.operators.fact import build_fact
from kpilens.plans import q_whatif as W
from kpilens.plans.kpi import KPI
from kpilens.plans.q_explain import drivers_ctes
from kpilens.plans.registry import kpi, periods, register
from kpilens.plans.sql_base import family, rename, with_

ORACLE: dict[str, str] = {}
MEASURES4 = ("revenue", "net_revenue", "orders", "items")


def _close_sql(a: str, b: str, rel: str = "1e-9") -> str:
    return f"COALESCE(ABS({a} - {b}) <= GREATEST({rel} * GREATEST(ABS({a}), ABS({b})), 1e-6), false)"


# ---------------------------------------------------------------- I1
@register("recon_monthly")
def recon_monthly(spark, d):
    """DataFrame path (E1) against the SQL path (E8), complete months."""
    k = kpi(spark, d)
    return I.recon_monthly(k.monthly, E.monthly_core_sql(k.star))


def _long(src: str, cols, val: str) -> str:
    return "\nUNION ALL\n".join(f"SELECT month, '{c}' AS measure, CAST({c} AS DOUBLE) AS {val} FROM {src}" for c in cols)


ORACLE["recon_monthly"] = with_("monthly", "o", "oi", "p", extra=f"""
sqlm AS (SELECT strftime(o.created_at, '%Y-%m') AS month, CAST(SUM(oi.sale_price) AS DOUBLE) AS revenue,
               CAST(SUM(CASE WHEN o.status NOT IN ('Cancelled', 'Returned') THEN oi.sale_price ELSE 0 END) AS DOUBLE)
                   AS net_revenue,
               COUNT(DISTINCT oi.order_id) AS orders, COUNT(*) AS items, CAST(SUM(oi.sale_price - p.cost) AS DOUBLE) AS profit
        FROM oi JOIN o ON o.order_id = oi.order_id JOIN p ON p.id = oi.product_id GROUP BY 1),
a AS ({_long('monthly', ('revenue', 'net_revenue', 'orders', 'items', 'profit'), 'fact_value')}),
b AS ({_long('sqlm', ('revenue', 'net_revenue', 'orders', 'items', 'profit'), 'sql_value')}
      ),
bb AS (SELECT * FROM b WHERE month IN (SELECT month FROM monthly))""") + f"""
SELECT COALESCE(a.month, bb.month) AS month, COALESCE(a.measure, bb.measure) AS measure,
       ROUND(a.fact_value, 6) AS fact_value, ROUND(bb.sql_value, 6) AS sql_value,
       {_close_sql('a.fact_value', 'bb.sql_value')} AS ok
FROM a FULL JOIN bb ON a.month = bb.month AND a.measure = bb.measure"""


# ---------------------------------------------------------------- I2
@register("recon_segments")
def recon_segments(spark, d):
    """Segment revenue of the SQL path (E9, E10) against the fact, last 3 months.
    Customer type is compared within the SQL twin's scope (first order over all orders)."""
    k, p = kpi(spark, d), periods(spark, d)
    months = p["last_3_months"]
    sql_parts = [E.revenue_by_dim_sql(k.star, m).select("dimension", F.lit(m).alias("month"), "segment",
                                                        F.col("revenue").alias("value")) for m in months]
    sql_parts += [E.revenue_by_customer_type_sql(k.star, m).select(
        F.lit("customer_type").alias("dimension"), F.lit(m).alias("month"), "segment",
        F.col("revenue").alias("value")) for m in months]
    sql = sql_parts[0]
    for x in sql_parts[1:]:
        sql = sql.unionByName(x)
    dims = tuple(E.DIM_SQL)
    fact_all = build_fact(k.star, Rules(scope="all_orders"))
    fv = I.segment_revenue(k.fact, months, dims).unionByName(
        I.segment_revenue(fact_all, months, ("customer_type",)))
    return I.compare(sql, fv, ["dimension", "month", "segment"], "sql_value", "fact_value")


def _seg_sql(dim: str, src: str) -> str:
    return (f"SELECT '{dim}' AS dimension, month, {dim} AS segment, CAST(SUM(sale_price) AS DOUBLE) AS fact_value "
            f"FROM {src} JOIN per USING (month) WHERE per.cur3 GROUP BY 1, 2, 3")


_SQLPATH = "\nUNION ALL\n".join(
    f"""SELECT '{n}' AS dimension, strftime(o.created_at, '%Y-%m') AS month, COALESCE({e}, '(unknown)') AS segment,
       CAST(SUM(oi.sale_price) AS DOUBLE) AS sql_value
FROM oi JOIN o ON o.order_id = oi.order_id JOIN p ON p.id = oi.product_id JOIN u ON u.id = o.user_id
     JOIN dc ON dc.id = oi.supplier_id JOIN per ON per.month = strftime(o.created_at, '%Y-%m')
WHERE per.cur3 GROUP BY 1, 2, 3""" for n, e in E.DIM_SQL.items()) + """
UNION ALL
SELECT 'customer_type', strftime(o.created_at, '%Y-%m'),
       CASE WHEN date_trunc('second', o.created_at) = fa.first_at THEN 'new' ELSE 'returning' END,
       CAST(SUM(oi.sale_price) AS DOUBLE)
FROM oi JOIN o ON o.order_id = oi.order_id JOIN fa ON fa.user_id = o.user_id
     JOIN per ON per.month = strftime(o.created_at, '%Y-%m')
WHERE per.cur3 GROUP BY 1, 2, 3"""

ORACLE["recon_segments"] = with_("fact", "per", extra=f"""
fa AS (SELECT user_id, MIN(date_trunc('second', created_at)) AS first_at FROM o GROUP BY user_id),
fact_all AS (SELECT f.*, CASE WHEN date_trunc('second', f.order_created_at) = fa.first_at THEN 'new' ELSE 'returning' END
                 AS ct_all FROM fact f JOIN fa ON fa.user_id = f.user_id),
s AS ({_SQLPATH}),
fv AS ({chr(10).join(' UNION ALL ' + _seg_sql(x, 'fact') if i else _seg_sql(x, 'fact') for i, x in enumerate(E.DIM_SQL))}
       UNION ALL SELECT 'customer_type', month, ct_all, CAST(SUM(sale_price) AS DOUBLE)
       FROM fact_all JOIN per USING (month) WHERE per.cur3 GROUP BY 1, 2, 3)""") + f"""
SELECT COALESCE(s.dimension, fv.dimension) AS dimension, COALESCE(s.month, fv.month) AS month,
       COALESCE(s.segment, fv.segment) AS segment, ROUND(s.sql_value, 6) AS sql_value,
       ROUND(fv.fact_value, 6) AS fact_value, {_close_sql('s.sql_value', 'fv.fact_value')} AS ok
FROM s FULL JOIN fv ON s.dimension = fv.dimension AND s.month = fv.month AND s.segment = fv.segment"""


# ---------------------------------------------------------------- I3 / I4
@register("fact_grain")
def fact_grain(spark, d):
    """One fact row per item: row counts before and after the joins."""
    k = kpi(spark, d)
    return (k.star.order_items.agg(F.count(F.lit(1)).alias("items"))
            .crossJoin(k.fact.agg(F.count(F.lit(1)).alias("fact_rows")))
            .withColumn("ok", F.col("items") == F.col("fact_rows")))


ORACLE["fact_grain"] = with_("fact") + """
SELECT (SELECT COUNT(*) FROM oi) AS items, (SELECT COUNT(*) FROM fact) AS fact_rows,
       (SELECT COUNT(*) FROM oi) = (SELECT COUNT(*) FROM fact) AS ok"""


@register("segments_sum")
def segments_sum(spark, d):
    """I4 (R17): the segments of every dimension add up to revenue, last 3 months."""
    k, p = kpi(spark, d), periods(spark, d)
    return I.segments_sum(k.cube, k.monthly, p["last_3_months"])


ORACLE["segments_sum"] = with_("fact", "per", "monthly") + "SELECT t.dimension, t.month, ROUND(CAST(t.s AS DOUBLE), 6) AS segments_total, " \
    "ROUND(m.revenue, 6) AS revenue, " + _close_sql("CAST(t.s AS DOUBLE)", "m.revenue") + " AS ok FROM (\n" + \
    "\nUNION ALL\n".join(f"SELECT '{x}' AS dimension, month, SUM(v) AS s FROM (SELECT month, {x}, SUM(sale_price) AS v "
                         f"FROM fact JOIN per USING (month) WHERE per.cur3 GROUP BY 1, 2) g GROUP BY 1, 2"
                         for x in DIMENSIONS) + "\n) t JOIN monthly m ON m.month = t.month"


# ---------------------------------------------------------------- I5
@register("identities")
def identities(spark, d):
    """Identities that hold whatever the right answer is (name, lhs, rhs, ok)."""
    k, p = kpi(spark, d), periods(spark, d)
    prev, cur, last3 = p["previous_month"], p["last_month"], p["last_3_months"]
    dec = X.decompose(k.monthly, prev, cur)
    rows = [("effects_sum_to_delta", F.col("volume_effect") + F.col("aov_effect"), F.col("delta")),
            ("effect_shares_sum_to_one", F.col("volume_share") + F.col("aov_share"), F.lit(1.0))]
    out = I.identity_rows(rows, dec)
    c = C.contribution_all(k.cube, prev, cur)
    per_dim = c.groupBy("dimension").agg(F.sum("share_of_change").alias("soc"), F.sum("share_of_base").alias("sob"),
                                         F.sum("delta").alias("dsum"))
    per_dim = per_dim.crossJoin(dec.select("delta"))
    for name, lhs, rhs in (("share_of_change_sums_to_one", "soc", F.lit(1.0)),
                           ("share_of_base_sums_to_one", "sob", F.lit(1.0)),
                           ("delta_sums_to_change", "dsum", F.col("delta"))):
        t = per_dim.select(F.concat(F.lit(name + ":"), "dimension").alias("name"), F.col(lhs).alias("lhs"),
                           rhs.cast("double").alias("rhs"))
        out = out.unionByName(t.withColumn("ok", I.close(F.col("lhs"), F.col("rhs"))))
    cn = C.contribution(k.cube, "dist_center", prev, cur, "net_revenue").agg(F.sum("delta").alias("l"))
    netchg = (k.monthly.filter(F.col("month") == cur[0]).select(F.col("net_revenue").alias("b"))
              .crossJoin(k.monthly.filter(F.col("month") == prev[0]).select(F.col("net_revenue").alias("a"))))
    out = out.unionByName(I.identity_rows([("net_delta_sums_to_net_change:dist_center", F.col("l"),
                                            F.col("b") - F.col("a"))], cn.crossJoin(netchg)))
    lk = C.leakage_by_dim(k.cube, cur[0], "dist_center").agg(
        F.sum(F.col("returned") * F.col("revenue")).alias("lr"), F.sum(F.col("cancelled") * F.col("revenue")).alias("lc"))
    total = k.cube.filter(F.col("dimension") == C.ALL)
    f = total.filter(F.col("month") == cur[0]).agg(
        F.sum(F.when(F.col("order_status") == "Returned", F.col("sale_price"))).cast("double").alias("rr"),
        F.sum(F.when(F.col("order_status") == "Cancelled", F.col("sale_price"))).cast("double").alias("rc"))
    out = out.unionByName(I.identity_rows([("returned_share_times_revenue:dist_center", F.col("lr"), F.col("rr")),
                                           ("cancelled_share_times_revenue:dist_center", F.col("lc"), F.col("rc"))],
                                          lk.crossJoin(f)))
    complete = total.filter(F.col("month") < k.rules.today_month)
    tot = complete.agg(F.sum("sale_price").cast("double").alias("ms")).crossJoin(E.total_before_today(k.star, k.rules))
    out = out.unionByName(I.identity_rows([("months_sum_to_total", F.col("ms"), F.col("revenue"))], tot))
    pt = E.period_totals(k.monthly, last3).crossJoin(
        k.monthly.filter(F.col("month").isin(last3)).agg(F.avg("aov").alias("mean_aov")))
    out = out.unionByName(I.identity_rows([("aov_is_ratio_of_totals", F.col("aov"),
                                            F.try_divide(F.col("revenue"), F.col("orders").cast("double")))], pt))
    out = out.unionByName(I.identity_rows([("aov_is_not_mean_of_monthly", F.col("aov"), F.col("mean_aov"))], pt,
                                          negate=True))
    return out


def _ident(name: str, lhs: str, rhs: str, src: str, negate: bool = False) -> str:
    ok = _close_sql(lhs, rhs, "1e-6" if negate else "1e-9")
    return (f"SELECT '{name}' AS name, ROUND(CAST({lhs} AS DOUBLE), 6) AS lhs, ROUND(CAST({rhs} AS DOUBLE), 6) AS rhs, "
            f"{'NOT ' if negate else ''}{ok} AS ok FROM {src}")


ORACLE["identities"] = with_("fact", "per", "monthly", "o", "oi", extra=f"""
a AS (SELECT SUM(revenue) AS revenue, SUM(orders) AS orders, SUM(revenue) / SUM(orders) AS aov
      FROM monthly JOIN per USING (month) WHERE per.prev1),
b AS (SELECT SUM(revenue) AS revenue, SUM(orders) AS orders, SUM(revenue) / SUM(orders) AS aov
      FROM monthly JOIN per USING (month) WHERE per.cur1),
dec AS (SELECT b.revenue - a.revenue AS delta, (b.orders - a.orders) * a.aov AS volume_effect,
               b.orders * (b.aov - a.aov) AS aov_effect,
               (b.orders - a.orders) * a.aov / (b.revenue - a.revenue) AS volume_share,
               b.orders * (b.aov - a.aov) / (b.revenue - a.revenue) AS aov_share FROM a CROSS JOIN b),
{drivers_ctes('prev1', 'cur1', 'sale_price', 'revenue')},
{rename(drivers_ctes('prev1', 'cur1', 'net_sale_price', 'net_revenue'), '_n', ('seg', 'c1', 'c2', 'contrib', 'guard', 'drv'))},
pd AS (SELECT dimension, SUM(share_of_change) AS soc, SUM(share_of_base) AS sob, SUM(delta) AS dsum
       FROM contrib GROUP BY dimension),
net AS (SELECT (SELECT SUM(delta) FROM contrib_n WHERE dimension = 'dist_center') AS l,
               (SELECT net_revenue FROM monthly JOIN per USING (month) WHERE per.cur1)
             - (SELECT net_revenue FROM monthly JOIN per USING (month) WHERE per.prev1) AS r),
lk AS (SELECT SUM(sale_price) AS rev,
              CAST(SUM(CASE WHEN order_status = 'Returned' THEN sale_price ELSE 0 END) AS DOUBLE) / CAST(SUM(sale_price) AS DOUBLE) AS ret,
              CAST(SUM(CASE WHEN order_status = 'Cancelled' THEN sale_price ELSE 0 END) AS DOUBLE) / CAST(SUM(sale_price) AS DOUBLE) AS can
       FROM fact JOIN per USING (month) WHERE per.cur1 GROUP BY dist_center),
lks AS (SELECT SUM(ret * CAST(rev AS DOUBLE)) AS lr, SUM(can * CAST(rev AS DOUBLE)) AS lc,
               (SELECT CAST(SUM(sale_price) AS DOUBLE) FROM fact JOIN per USING (month) WHERE per.cur1 AND order_status = 'Returned') AS rr,
               (SELECT CAST(SUM(sale_price) AS DOUBLE) FROM fact JOIN per USING (month) WHERE per.cur1 AND order_status = 'Cancelled') AS rc
        FROM lk),
tot AS (SELECT (SELECT CAST(SUM(revenue_d) AS DOUBLE) FROM mcore) AS ms,
               (SELECT CAST(SUM(oi.sale_price) AS DOUBLE) FROM oi JOIN o ON o.order_id = oi.order_id
                 WHERE o.created_at < TIMESTAMP '2001-08-01 00:00:00') AS t),
pt AS (SELECT SUM(revenue) / SUM(orders) AS aov, SUM(revenue) AS revenue, SUM(orders) AS orders, AVG(aov) AS mean_aov
       FROM monthly JOIN per USING (month) WHERE per.cur3)""") + "\nUNION ALL\n".join([
    _ident("effects_sum_to_delta", "volume_effect + aov_effect", "delta", "dec"),
    _ident("effect_shares_sum_to_one", "volume_share + aov_share", "1.0", "dec"),
    "SELECT 'share_of_change_sums_to_one:' || dimension, ROUND(soc, 6), 1.0, " + _close_sql("soc", "1.0") + " FROM pd",
    "SELECT 'share_of_base_sums_to_one:' || dimension, ROUND(sob, 6), 1.0, " + _close_sql("sob", "1.0") + " FROM pd",
    "SELECT 'delta_sums_to_change:' || dimension, ROUND(dsum, 6), ROUND(dec.delta, 6), " +
    _close_sql("dsum", "dec.delta") + " FROM pd CROSS JOIN dec",
    _ident("net_delta_sums_to_net_change:dist_center", "l", "r", "net"),
    _ident("returned_share_times_revenue:dist_center", "lr", "rr", "lks"),
    _ident("cancelled_share_times_revenue:dist_center", "lc", "rc", "lks"),
    _ident("months_sum_to_total", "ms", "t", "tot"),
    _ident("aov_is_ratio_of_totals", "aov", "revenue / orders", "pt"),
    _ident("aov_is_not_mean_of_monthly", "aov", "mean_aov", "pt", negate=True)])


# ---------------------------------------------------------------- I7 / I8
@register("child_parent_agree")
def child_parent_agree(spark, d):
    """An order's status agrees with its items' over all orders: the one status all items have,
    or P where they differ."""
    raw = kpi(spark, d).star.raw
    lines = raw["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_linestatus").alias("lo"), F.max("l_linestatus").alias("hi"))
    j = raw["orders"].select("o_orderkey", "o_orderstatus").join(lines, "o_orderkey")
    wanted = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise("P")
    return j.agg(F.count(F.lit(1)).alias("checked"),
                 F.sum((wanted != F.col("o_orderstatus")).cast("long")).alias("mismatches"))


ORACLE["child_parent_agree"] = """
SELECT COUNT(*) AS checked, SUM(CASE WHEN CASE WHEN lo = hi THEN lo ELSE 'P' END <> o_orderstatus THEN 1 ELSE 0 END) AS mismatches
FROM orders JOIN (SELECT l_orderkey, MIN(l_linestatus) AS lo, MAX(l_linestatus) AS hi FROM lineitem GROUP BY 1) t
ON o_orderkey = l_orderkey"""


@register("vocabulary_diff")
def vocabulary_diff(spark, d):
    """I8 (R14): acquisition vs session traffic-source vocabularies."""
    k = kpi(spark, d)
    return I.vocabulary_diff(k.star.users, "traffic_source", k.sessions, "traffic_source")


ORACLE["vocabulary_diff"] = with_("u", "sess") + """
SELECT COALESCE(a.value, b.value) AS value, a.value IS NOT NULL AS in_acquisition, b.value IS NOT NULL AS in_session
FROM (SELECT DISTINCT traffic_source AS value FROM u) a FULL JOIN (SELECT DISTINCT traffic_source AS value FROM sess) b
ON a.value = b.value"""


# ---------------------------------------------------------------- I9 / I10 (surge)
def _surge_kpi(spark, d) -> tuple[KPI, object]:
    edited, new_orders = W.surge_edit(spark, d)
    return KPI(spark, d, star=edited), new_orders


@register("recon_what_if")
def recon_what_if(spark, d):
    """Base + declared change = edited copy, month by month (surge scenario)."""
    k = kpi(spark, d)
    ks, new_orders = _surge_kpi(spark, d)
    base = I.long_form(k.monthly, ["month"], list(MEASURES4), "base")
    delta = I.long_form(J.planted_delta(k.star, new_orders), ["month"], list(MEASURES4), "delta")
    scen = I.long_form(ks.monthly, ["month"], list(MEASURES4), "scenario")
    j = base.join(delta, ["month", "measure"], "left").join(scen, ["month", "measure"], "full")
    j = j.withColumn("delta", F.coalesce("delta", F.lit(0.0)))
    return j.withColumn("ok", I.close(F.col("base") + F.col("delta"), F.col("scenario")))


def _surge_family(sfx: str = "_s") -> str:
    rep = {
        "o": "o AS (SELECT order_id, user_id, status, created_at, total_price FROM o__B UNION ALL "
             "SELECT order_id, user_id, status, created_at, total_price FROM new_orders)",
        "oi": "oi AS (SELECT * FROM oi__B UNION ALL SELECT nn.order_id, bi.line_number, bi.product_id, bi.supplier_id, "
              "bi.sale_price, bi.quantity, bi.line_status, bi.created_at FROM oi__B bi "
              "JOIN new_orders nn ON nn.source_order_id = bi.order_id)",
        "u": "u AS (SELECT * FROM u__B UNION ALL SELECT nn.user_id AS id, bu.name, bu.country, bu.traffic_source, "
             "bu.acctbal FROM new_orders nn JOIN u__B bu ON bu.id = nn.source_user_id)",
    }
    parts = family("monthly", "per", sfx=sfx, replace=rep)
    return ",\n".join(parts).replace("o__B", "o").replace("oi__B", "oi").replace("u__B", "u")


ORACLE["recon_what_if"] = with_("monthly", "per", "u", extra=W.SURGE_SQL.strip() + ",\n" + _surge_family() + """,
dl AS (SELECT strftime(nn.created_at, '%Y-%m') AS month, CAST(SUM(bi.sale_price) AS DOUBLE) AS revenue,
              CAST(SUM(CASE WHEN COALESCE(nn.status IN ('Cancelled', 'Returned'), false) THEN 0 ELSE bi.sale_price END)
                   AS DOUBLE) AS net_revenue,
              COUNT(DISTINCT nn.order_id) AS orders, COUNT(*) AS items
       FROM new_orders nn JOIN oi bi ON bi.order_id = nn.source_order_id GROUP BY 1),""" + f"""
bl AS ({_long('monthly', MEASURES4, 'base')}),
dll AS ({_long('dl', MEASURES4, 'delta')}),
sl AS ({_long('monthly_s', MEASURES4, 'scenario')})""") + f"""
SELECT COALESCE(bl.month, sl.month) AS month, COALESCE(bl.measure, sl.measure) AS measure, ROUND(bl.base, 6) AS base,
       ROUND(COALESCE(dll.delta, 0.0), 6) AS delta, ROUND(sl.scenario, 6) AS scenario,
       {_close_sql('bl.base + COALESCE(dll.delta, 0.0)', 'sl.scenario')} AS ok
FROM bl LEFT JOIN dll ON dll.month = bl.month AND dll.measure = bl.measure
FULL JOIN sl ON sl.month = bl.month AND sl.measure = bl.measure"""


@register("driver_diff")
def driver_diff(spark, d):
    """Gross drivers of last month, base against the surge copy."""
    k, p = kpi(spark, d), periods(spark, d)
    ks, _ = _surge_kpi(spark, d)
    prev, cur = p["previous_month"], p["last_month"]
    base = C.find_drivers(k.cube, prev, cur)
    scen = X.find_drivers(ks.fact, prev, cur)
    return I.driver_diff(base, scen)


ORACLE["driver_diff"] = with_("fact", "monthly", "per", extra=W.SURGE_SQL.strip() + ",\n" + _surge_family() + ",\n" +
                              drivers_ctes("prev1", "cur1", "sale_price", "revenue") + ",\n" +
                              rename(drivers_ctes("prev1", "cur1", "sale_price", "revenue"), "_s")) + """
SELECT COALESCE(b.dimension, s.dimension) AS dimension, COALESCE(b.segment, s.segment) AS segment,
       b.dimension IS NOT NULL AS in_base, s.dimension IS NOT NULL AS in_scenario, s.driver_rank AS scenario_rank,
       ROUND(s.share_of_change, 6) AS scenario_share, ROUND(s.lift, 6) AS scenario_lift
FROM drv b FULL JOIN drv_s s ON b.dimension = s.dimension AND b.segment = s.segment"""


# ---------------------------------------------------------------- I11 (flip)
@register("level_margin")
def level_margin(spark, d):
    """After the returns plant, the planted centre's returned share clears the level
    margins in each planted month."""
    k, p = kpi(spark, d), periods(spark, d)
    edited, _ = W.flip_edit(spark, d)
    ks = KPI(spark, d, star=edited)
    seg = W._candidates(spark, d).select("segment").distinct()
    return I.level_margin(ks.fact, p["previous_month"] + p["last_month"], seg)


ORACLE["level_margin"] = with_("fact", "per", extra=W.SAMPLE_SQL.strip() + ",\n" + ",\n".join(family(
    "fact", sfx="_s", replace={"o": "o AS (SELECT order_id, user_id, CASE WHEN order_id IN (SELECT order_id FROM picked) "
                                    "THEN 'Returned' ELSE status END AS status, created_at, total_price FROM o__B)"}))
    .replace("o__B", "o") + """,
g AS (SELECT f.month, f.dist_center AS segment,
             CAST(SUM(CASE WHEN f.order_status = 'Returned' THEN f.sale_price ELSE 0 END) AS DOUBLE)
               / NULLIF(CAST(SUM(f.sale_price) AS DOUBLE), 0) AS returned
      FROM fact_s f JOIN per ON per.month = f.month WHERE per.cur1 OR per.prev1 GROUP BY 1, 2),
pl AS (SELECT DISTINCT segment FROM cand)""") + """
SELECT g.month, g.segment, ROUND(g.returned, 6) AS returned, ROUND(o.others_max, 6) AS others_max,
       COALESCE(g.returned >= 0.30 AND g.returned >= 3.0 * o.others_max, false) AS ok
FROM g JOIN pl ON pl.segment = g.segment
LEFT JOIN (SELECT g2.month, MAX(g2.returned) AS others_max FROM g g2 WHERE g2.segment NOT IN (SELECT segment FROM pl)
           GROUP BY 1) o ON o.month = g.month"""
