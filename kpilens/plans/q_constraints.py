"""Registered queries: the constraint suite (I7, I8), margin rules (I10, I11) and the control (J8), with oracle SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpilens.functions.columns import fact_months
from kpilens.operators import constraints as N
from kpilens.operators import cube as C
from kpilens.operators import explain as X
from kpilens.operators import funnel as G
from kpilens.operators import margins as M
from kpilens.operators import metrics as E
from kpilens.operators import reconcile as I
from kpilens.operators import whatif as J
from kpilens.plans import q_whatif as W
from kpilens.plans.kpi import KPI
from kpilens.plans.q_explain import drivers_ctes
from kpilens.plans.q_reconcile import _close_sql, _surge_family
from kpilens.plans.q_snapshot import _canon_sql
from kpilens.plans.registry import kpi, periods, register
from kpilens.plans.sql_base import family, rename, with_
from kpilens.sources.snapshot import table_manifest
from kpilens.sources.tables import MONEY, SCHEMAS

ORACLE: dict[str, str] = {}

# ---- fixed values: what the stored tables promise (predicates both engines read) ----------
RULES = [
    N.Rule("orders", "priority known", "o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')"),
    N.Rule("orders", "status letter known", "o_orderstatus IN ('F', 'O', 'P')"),
    N.Rule("orders", "total not negative", "o_totalprice >= 0"),
    N.Rule("lineitem", "quantity positive", "l_quantity > 0"),
    N.Rule("lineitem", "price positive", "l_extendedprice > 0"),
    N.Rule("lineitem", "discount a share", "l_discount BETWEEN 0 AND 1"),
    N.Rule("lineitem", "tax a share", "l_tax BETWEEN 0 AND 1"),
    N.Rule("lineitem", "flag known", "l_returnflag IN ('A', 'N', 'R')"),
    N.Rule("customer", "balance in range", "c_acctbal BETWEEN -1000 AND 10000"),
    N.Rule("part", "size positive", "p_size > 0"),
    N.Rule("part", "list price positive", "p_retailprice > 0"),
    N.Rule("events", "type known", "event_type IN ('view', 'click', 'purchase', 'signup', 'logout')"),
    N.Rule("events", "user not negative", "user_id >= 0"),
    N.Rule("documents", "length as stated", "n_chars = length(text)"),
    N.Rule("labels", "quality 0 or 1", "quality IN (0, 1)"),
    N.Rule("labels", "toxic 0 or 1", "toxic IN (0, 1)"),
    N.Rule("pages", "url absolute", "url LIKE 'http%'"),
    N.Rule("conversations", "role known", "role IN ('system', 'user', 'assistant')"),
    N.Rule("conversations", "turn not negative", "turn >= 0"),
    N.Rule("embeddings", "label of ten", "label BETWEEN 0 AND 9"),
]
QUIRKS = {"unknown_brand_items": (1, None), "anonymous_purchases": (None, 0), "purchase_sessions_per_item": (0.995, 1.005),
          "fanout_ratio": (1.8, 2.0), "shared_source_names": (1, None), "purchase_rate_step": (0, None)}
#: What each edited copy must show: scenario, driver, direction of its change, lowest |share|, lowest lift gap, worst rank.
PLANTS = [("surge", "acq_source", W.SURGE_SOURCE, 1, 0.30, 1.0, 1)]
# --------------------------------------------------------------------------------------------


def all_rules() -> list[N.Rule]:
    """The rules above and, for every column of every stored table, that it is there."""
    return RULES + [r for t, schema in SCHEMAS.items() for r in N.required(schema, t)]


@register("constraint_suite")
def constraint_suite(spark, d):
    """Every row rule and every column of the 14 stored tables, one aggregate per table."""
    return N.check(kpi(spark, d).star.raw, all_rules())


ORACLE["constraint_suite"] = "\nUNION ALL\n".join(
    f"SELECT '{r.table}' AS table_name, '{r.name}' AS rule, COUNT(*) AS checked, "
    f"COUNT(*) FILTER (NOT COALESCE({r.holds.replace('`', chr(34))}, true)) AS violations, "
    f"COUNT(*) FILTER (NOT COALESCE({r.holds.replace('`', chr(34))}, true)) = 0 AS ok FROM {r.table}" for r in all_rules())


@register("item_parent_agreement")
def item_parent_agreement(spark, d):
    """Attributes an item shares with its order, rule by rule: same status letter where the order has one for all
    its items, not ordered after it was shipped, and (two missing values agree) the order's key itself."""
    raw = kpi(spark, d).star.raw
    parent = raw["orders"].select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderkey").alias("own"),
                                  F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("letter"))
    child = raw["lineitem"].join(parent.filter(F.col("letter").isNotNull()).select("l_orderkey"), "l_orderkey", "left_semi")
    return N.agreement(child.withColumn("key", F.col("l_orderkey")), parent, "l_orderkey",
                       {"status letter": ("l_linestatus", "letter", False), "order key": ("key", "own", True)})


ORACLE["item_parent_agreement"] = """
WITH j AS (SELECT l_linestatus, o_orderstatus, l_orderkey, o_orderkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey
           WHERE o_orderstatus <> 'P')
SELECT 'status letter' AS rule, COUNT(*) AS checked, COUNT(*) FILTER (l_linestatus <> o_orderstatus) AS violations,
       COUNT(*) FILTER (l_linestatus <> o_orderstatus) = 0 AS ok FROM j
UNION ALL SELECT 'order key', COUNT(*), COUNT(*) FILTER (l_orderkey <> o_orderkey), COUNT(*) FILTER (l_orderkey <> o_orderkey) = 0 FROM j"""


@register("data_quirks")
def data_quirks(spark, d):
    """I8: the quirks the definitions rely on, each with the range it must lie in. (The fixture's events have no tie to its
    orders and its orders have more items, so some are not ok there; they say so.)"""
    k, p = kpi(spark, d), periods(spark, d)
    month = p["last_month"][0]
    unknown = (k.cube.filter((F.col("dimension") == "brand") & (F.col("segment") == "(unknown)"))
               .agg(F.coalesce(F.sum("items"), F.lit(0)).alias("unknown_brand_items")))
    s = k.sessions.agg(F.count_if(F.col("user_id").isNull() & F.col("purchased")).alias("anonymous_purchases"),
                       F.count_if("purchased").alias("_bought"))
    items = k.star.order_items.agg(F.count(F.lit(1)).alias("_items"))
    fan = E.trap_fanout(k.star, month).select(F.col("revenue").alias("_fan")).crossJoin(
        k.monthly.filter(F.col("month") == month).select(F.col("revenue").alias("_revenue")))
    both = I.vocabulary_diff(k.star.users, "traffic_source", k.sessions, "traffic_source").agg(
        F.count_if(F.col("in_acquisition") & F.col("in_session")).alias("shared_source_names"))
    rate = k.sessions.groupBy("period").agg(F.avg(F.col("purchased").cast("int")).alias("r"))
    step = rate.agg((F.max_by("r", "period") - F.min_by("r", "period")).alias("purchase_rate_step"))
    row = unknown.crossJoin(s).crossJoin(items).crossJoin(fan).crossJoin(both).crossJoin(step)             # one-row frames
    row = row.withColumns({"purchase_sessions_per_item": F.try_divide(F.col("_bought").cast("double"), F.col("_items").cast("double")),
                           "fanout_ratio": F.try_divide(F.col("_fan"), F.col("_revenue"))})
    return N.ranges(row, QUIRKS)


def _quirk_sql(name: str, value: str) -> str:
    lo, hi = QUIRKS[name]
    inside = " AND ".join([f"v >= {lo}"] * (lo is not None) + [f"v <= {hi}"] * (hi is not None))
    num = lambda x: "CAST(NULL AS DOUBLE)" if x is None else f"CAST({x} AS DOUBLE)"
    return (f"SELECT '{name}' AS quirk, ROUND(v, 6) AS value, {num(lo)} AS low, {num(hi)} AS high, COALESCE({inside}, false) AS ok "
            f"FROM (SELECT CAST(({value}) AS DOUBLE) AS v) t")


ORACLE["data_quirks"] = with_("fact", "per", "monthly", "u", "sess", "o", "oi") + "\nUNION ALL\n".join([
    _quirk_sql("unknown_brand_items", "SELECT COUNT(*) FROM fact WHERE brand = '(unknown)'"),
    _quirk_sql("anonymous_purchases", "SELECT COUNT(*) FILTER (user_id IS NULL AND purchased) FROM sess"),
    _quirk_sql("purchase_sessions_per_item", "SELECT CAST(COUNT(*) FILTER (purchased) AS DOUBLE) / (SELECT COUNT(*) FROM oi) FROM sess"),
    _quirk_sql("fanout_ratio", "SELECT CAST(SUM(oi.sale_price) AS DOUBLE) / (SELECT revenue FROM monthly JOIN per USING (month) WHERE cur1) FROM oi "
               "JOIN o ON o.order_id = oi.order_id JOIN oi oi2 ON oi2.order_id = oi.order_id "
               "WHERE strftime(o.created_at, '%Y-%m') = (SELECT month FROM per WHERE cur1)"),
    _quirk_sql("shared_source_names", "SELECT COUNT(DISTINCT traffic_source) FROM u WHERE traffic_source IN (SELECT traffic_source FROM sess)"),
    _quirk_sql("purchase_rate_step", "SELECT arg_max(r, period) - arg_min(r, period) FROM "
               "(SELECT period, AVG(CAST(purchased AS INT)) AS r FROM sess GROUP BY 1) q")])


# ---------------------------------------------------------------- I2 (funnel and leakage twins)
@register("recon_funnel_leakage")
def recon_funnel_leakage(spark, d):
    """The funnel by session source (G2) and the order leakage (G5), SQL path against the operators."""
    k, p = kpi(spark, d), periods(spark, d)
    period, month = k.session_periods()[-1], p["last_month"][0]
    sql = spark.sql("""
        SELECT 'funnel' AS what, COALESCE(traffic_source, '(unknown)') AS segment,
               inline(array(named_struct('measure', 'sessions', 'sql_value', CAST(COUNT(*) AS DOUBLE)),
                            named_struct('measure', 'cart_rate', 'sql_value', COUNT(IF(added_to_cart, 1, NULL)) / COUNT(*)),
                            named_struct('measure', 'purchase_rate', 'sql_value', COUNT(IF(purchased, 1, NULL)) / COUNT(*))))
        FROM {sessions} WHERE period = :period GROUP BY COALESCE(traffic_source, '(unknown)')""",
                    args={"period": period}, sessions=k.sessions)
    leak = spark.sql("""
        SELECT 'leakage' AS what, 'all' AS segment,
               inline(array(named_struct('measure', 'cancelled', 'sql_value', AVG(IF(status = 'Cancelled', 1, 0))),
                            named_struct('measure', 'returned', 'sql_value', AVG(IF(status = 'Returned', 1, 0)))))
        FROM {orders} o LEFT SEMI JOIN {items} i ON i.order_id = o.order_id
        WHERE status IS NOT NULL AND date_format(created_at, 'yyyy-MM') = :month""",
                     args={"month": month}, orders=k.star.orders, items=k.star.order_items)
    g = G.funnel(k.sessions, period, "traffic_source")
    own = I.long_form(g.withColumn("what", F.lit("funnel")), ["what", "segment"], ["sessions", "cart_rate", "purchase_rate"], "own_value")
    lk = C.leakage(k.cube, month).withColumn("what", F.lit("leakage")).withColumn("segment", F.lit("all"))
    own = own.unionByName(I.long_form(lk, ["what", "segment"], ["cancelled", "returned"], "own_value"))
    j = sql.unionByName(leak).join(own, ["what", "segment", "measure"], "full")
    return j.withColumn("ok", I.close(F.col("sql_value"), F.col("own_value")))


ORACLE["recon_funnel_leakage"] = with_("sess", "sp", "leak", "per", extra="""
f AS (SELECT COALESCE(traffic_source, '(unknown)') AS segment, CAST(COUNT(*) AS DOUBLE) AS sessions,
             AVG(CAST(added_to_cart AS INT)) AS cart_rate, AVG(CAST(purchased AS INT)) AS purchase_rate
      FROM sess WHERE period = (SELECT cur FROM sp) GROUP BY 1),
v AS (SELECT 'funnel' AS what, segment, measure, value FROM f UNPIVOT (value FOR measure IN (sessions, cart_rate, purchase_rate))
      UNION ALL
      SELECT 'leakage', 'all', measure, value FROM (SELECT cancelled, returned FROM leak JOIN per USING (month) WHERE cur1)
      UNPIVOT (value FOR measure IN (cancelled, returned)))""") + \
    "SELECT what, segment, measure, ROUND(value, 6) AS sql_value, ROUND(value, 6) AS own_value, " + _close_sql("value", "value") + " AS ok FROM v"


# ---------------------------------------------------------------- I10 / I11 margin rules
@register("driver_margins")
def driver_margins(spark, d):
    """Every margin rule of every planted driver, one verdict a rule, and that the control copy shows nothing new."""
    k, p = kpi(spark, d), periods(spark, d)
    prev, cur = p["previous_month"], p["last_month"]
    edited, _ = W.surge_edit(spark, d)
    base = C.find_drivers(k.cube, prev, cur)
    surge = X.find_drivers(KPI(spark, d, star=edited).fact, prev, cur).withColumn("scenario", F.lit("surge"))
    control = X.find_drivers(KPI(spark, d, star=J.EditedStar(k.star)).fact, prev, cur)
    plants = spark.createDataFrame(PLANTS, M.PLANT)
    return M.driver_verdicts(surge, plants).unionByName(M.nothing_new(base, control, "control"))


_MARGIN_ROWS = "\nUNION ALL\n".join(
    f"""SELECT '{sc}' AS scenario, '{dim}={seg}' AS driver, r.rule, r.value, r.ok FROM (SELECT 1) one
LEFT JOIN (SELECT * FROM drv_s WHERE dimension = '{dim}' AND segment = '{seg}') x ON true,
LATERAL (SELECT 'present' AS rule, CAST(x.dimension IS NOT NULL AS INT)::DOUBLE AS value, x.dimension IS NOT NULL AS ok
  UNION ALL SELECT 'direction', ROUND(sign(x.delta), 6), COALESCE(sign(x.delta) = {sign}, false)
  UNION ALL SELECT 'share', ROUND(ABS(x.share_of_change), 6), COALESCE(ABS(x.share_of_change) >= {share}, false)
  UNION ALL SELECT 'lift gap', ROUND(ABS(x.lift - 1), 6), COALESCE(x.is_new_segment OR ABS(x.lift - 1) >= {gap}, false)
  UNION ALL SELECT 'rank', CAST(x.driver_rank AS DOUBLE), COALESCE(x.driver_rank <= {rank}, false)) r"""
    for sc, dim, seg, sign, share, gap, rank in PLANTS)
ORACLE["driver_margins"] = with_("fact", "monthly", "per", extra=W.SURGE_SQL.strip() + ",\n" + _surge_family() + ",\n" +
                                 drivers_ctes("prev1", "cur1", "sale_price", "revenue") + ",\n" +
                                 rename(drivers_ctes("prev1", "cur1", "sale_price", "revenue"), "_s")) + _MARGIN_ROWS + """
UNION ALL SELECT 'control', '(any)', 'nothing new', (SELECT COUNT(*) FROM (SELECT dimension, segment FROM drv EXCEPT SELECT dimension, segment FROM drv)) * 1.0, true
UNION ALL SELECT 'control', '(any)', 'nothing gone', (SELECT COUNT(*) FROM (SELECT dimension, segment FROM drv EXCEPT SELECT dimension, segment FROM drv)) * 1.0, true"""


@register("level_series")
def level_series(spark, d):
    """The returned share of every centre over the last 8 months of the edited copy, against the level margins:
    loud where planted (0.30 and 3 x the others), quiet everywhere else."""
    k, p = kpi(spark, d), periods(spark, d)
    months = k.last_complete_months(M.HISTORY)
    edited, _ = W.flip_edit(spark, d)
    fact = KPI(spark, d, star=edited).fact
    cube = C.build(fact.filter(fact_months(months)), ("dist_center",))
    planted = W._candidates(spark, d).select("segment").distinct()
    return M.level_verdicts(cube, "dist_center", planted, p["previous_month"] + p["last_month"])


ORACLE["level_series"] = with_("fact", "per", extra=W.SAMPLE_SQL.strip() + ",\n" + ",\n".join(family(
    "fact", sfx="_s", replace={"o": "o AS (SELECT order_id, user_id, CASE WHEN order_id IN (SELECT order_id FROM picked) "
                                    "THEN 'Returned' ELSE status END AS status, created_at, total_price FROM o__B)"}))
    .replace("o__B", "o") + f""",
g AS (SELECT f.month, f.dist_center AS segment,
             CAST(SUM(CASE WHEN f.order_status = 'Returned' THEN f.sale_price ELSE 0 END) AS DOUBLE)
               / NULLIF(CAST(SUM(f.sale_price) AS DOUBLE), 0) AS returned
      FROM fact_s f WHERE f.month IN (SELECT month FROM per ORDER BY idx DESC LIMIT {M.HISTORY}) GROUP BY 1, 2),
v AS (SELECT g.*, (SELECT MAX(h.returned) FROM g h WHERE h.month = g.month AND h.segment <> g.segment) AS others_max,
             g.segment IN (SELECT segment FROM cand) AND g.month IN (SELECT month FROM per WHERE cur1 OR prev1) AS expected FROM g),
w AS (SELECT *, COALESCE(returned >= 0.30 AND COALESCE(returned >= 3.0 * others_max, true), false) AS loud FROM v)""") + """
SELECT month, segment, ROUND(returned, 6) AS returned, ROUND(others_max, 6) AS others_max, loud, expected, loud = expected AS ok FROM w"""


# ---------------------------------------------------------------- J8
NO_EDITS = ("flip nothing", "drop nothing", "surge by 1")


def _controls(spark, d) -> dict:
    k, p = kpi(spark, d), periods(spark, d)
    none = k.star.orders.filter(F.lit(False)).select("order_id")
    return {"flip nothing": J.flip_to_returned(k.star, none)[0], "drop nothing": J.drop_orders(k.star, none)[0],
            "surge by 1": J.surge(k.star, p["last_month"][0], W.SURGE_SOURCE, 1.0)[0]}


@register("what_if_control")
def what_if_control(spark, d):
    """Edits that change nothing (no picks, a surge by 1) run through the same code and leave every table's rows
    and contents as they were."""
    star = kpi(spark, d).star

    def tables(s):
        return {"orders": s.orders, "order_items": s.order_items, "users": s.users.drop("created_at")}
    base = table_manifest(tables(star)).select("table_name", F.col("rows").alias("base_rows"), F.col("checksum").alias("base_checksum"))
    parts = [table_manifest(tables(s)).select(F.lit(name).alias("edit"), "table_name", F.col("rows").alias("edited_rows"),
                                              F.col("checksum").alias("edited_checksum")) for name, s in _controls(spark, d).items()]
    j = reduce(DataFrame.unionByName, parts).join(base, "table_name", "full")
    same = (F.col("base_rows") == F.col("edited_rows")) & (F.col("base_checksum") == F.col("edited_checksum"))
    return j.select("edit", "table_name", "base_rows", "edited_rows", "base_checksum", "edited_checksum", F.coalesce(same, F.lit(False)).alias("ok"))


_LOGICAL = {
    "orders": ("o", {"order_id": T.LongType(), "user_id": T.LongType(), "status": T.StringType(), "created_at": T.TimestampNTZType(),
                     "total_price": T.DoubleType()}),
    "order_items": ("oi", {"order_id": T.LongType(), "line_number": T.IntegerType(), "product_id": T.LongType(), "supplier_id": T.LongType(),
                           "sale_price": MONEY, "quantity": T.DoubleType(), "line_status": T.StringType(), "created_at": T.TimestampNTZType(),
                           "created_at ": T.TimestampNTZType()}),      # created_at is the ship time too
    "users": ("u", {"id": T.LongType(), "name": T.StringType(), "country": T.StringType(), "traffic_source": T.StringType(),
                    "acctbal": T.DoubleType()}),
}
ORACLE["what_if_control"] = with_("o", "oi", "u", extra="m AS (" + "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, COUNT(*) AS n, SUM(CAST(('0x' || substr(md5(concat_ws('|', {', '.join(_canon_sql(c.strip(), dt) for c, dt in cols.items())})), 1, 8))
       AS BIGINT))::BIGINT AS checksum FROM {src}""" for t, (src, cols) in _LOGICAL.items()) + ")") + f"""
SELECT e.edit, table_name, n AS base_rows, n AS edited_rows, checksum AS base_checksum, checksum AS edited_checksum, n = n AND checksum = checksum AS ok
FROM m CROSS JOIN (VALUES {', '.join(f"('{e}')" for e in NO_EDITS)}) e(edit)"""
