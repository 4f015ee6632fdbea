"""Registered queries: snapshot sources and checks (A5-A8, B1-B6, B8), with oracle SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import types as T

from kpilens.config import FIXTURE_TODAY
from kpilens.plans.registry import kpi, register
from kpilens.plans.sql_base import TODAY, ts, with_
from kpilens.session import ensure_checkpoint_dir
from kpilens.sources import snapshot as S
from kpilens.sources.tables import SCHEMAS

ORACLE: dict[str, str] = {}
#: Fixture mapping for B3 / B4: the events' first day is read as 1995-01-01, where the orders begin, and the cut is made early
#: enough that neither branch holds every row.
OPENING_CUTOFF = "1995-01-03"
OPENING_SHIFT_DAYS = 10592
REQUIRED_EVENT_TYPES = ["view", "click", "purchase"]


def _scalar_cols(name: str) -> list[tuple[str, T.DataType]]:
    bad = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    return [(f.name, f.dataType) for f in SCHEMAS[name].fields if not isinstance(f.dataType, bad)]


@register("schema_columns")
def schema_columns(spark, d):
    """A5: exportable columns of every table, in order, with non-null counts."""
    return S.schema_columns(kpi(spark, d).star.raw)


ORACLE["schema_columns"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, {i + 1} AS position, '{c}' AS column_name, COUNT({c}) AS non_null FROM {t}"
    for t in SCHEMAS for i, (c, _) in enumerate(_scalar_cols(t)))


def _canon_sql(c: str, dt: T.DataType) -> str:
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return f"CAST(CAST(ROUND({c} * 100) AS BIGINT) AS VARCHAR)"
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return ts(c)
    return f"CAST({c} AS VARCHAR)"


@register("table_manifest")
def table_manifest(spark, d):
    """Rows, columns and an order-free content checksum per table."""
    return S.table_manifest(kpi(spark, d).star.raw)


ORACLE["table_manifest"] = "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, COUNT(*) AS rows, '{','.join(c for c, _ in _scalar_cols(t))}' AS columns,
       SUM(CAST(('0x' || substr(md5(concat_ws('|', {', '.join(_canon_sql(c, dt) for c, dt in _scalar_cols(t))})), 1, 8))
                AS BIGINT)) AS checksum FROM {t}""" for t in SCHEMAS)


_PUBLISHED: dict[tuple[str, str], str] = {}


def published(spark, d) -> str:
    """The folder of this directory's snapshot, written once per application under the shared folder."""
    key = (spark.sparkContext.applicationId, d.rstrip("/"))
    if key not in _PUBLISHED:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kpilens-snapshot-{uuid.uuid4().hex}"
        _PUBLISHED[key] = S.publish_snapshot(S.cut_tables(kpi(spark, d).star, FIXTURE_TODAY), path)
    return _PUBLISHED[key]


@register("manifest_check")
def manifest_check(spark, d):
    """The published snapshot, read back, has the rows, columns and contents its manifest states."""
    path = published(spark, d)
    return S.verify_snapshot(S.read_manifest(spark, path), S.read_snapshot(spark, path, SCHEMAS))


@register("source_against_manifest")
def source_against_manifest(spark, d):
    """The source tables, cut anew, still are what the published manifest states."""
    return S.verify_snapshot(S.read_manifest(spark, published(spark, d)), S.cut_manifest(kpi(spark, d).star, FIXTURE_TODAY))


_CUT = {
    "orders": f"o_orderdate < TIMESTAMP '{TODAY} 00:00:00'",
    "lineitem": "l_orderkey IN (SELECT o_orderkey FROM kept)",
    "customer": "c_custkey IN (SELECT o_custkey FROM kept)",
    "part": "p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM kept))",
}
_FOUND = f"WITH kept AS (SELECT * FROM orders WHERE {_CUT['orders']}), found AS (" + "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS table_name, COUNT(*) AS n,
       COALESCE(SUM(CAST(('0x' || substr(md5(concat_ws('|', {', '.join(_canon_sql(c, dt) for c, dt in _scalar_cols(t))})), 1, 8))
                AS BIGINT)), 0)::BIGINT AS checksum FROM {t} WHERE {_CUT.get(t, 'true')}""" for t in SCHEMAS) + ")"
ORACLE["manifest_check"] = ORACLE["source_against_manifest"] = _FOUND + """
SELECT a.table_name, a.n AS manifest_rows, b.n AS loaded_rows, a.checksum AS manifest_checksum, b.checksum AS loaded_checksum,
       a.n = b.n AND a.checksum = b.checksum AS ok
FROM found a JOIN found b USING (table_name)"""


@register("snapshot_orders")
def snapshot_orders(spark, d):
    """Orders created before the cutoff."""
    return S.snapshot_orders(kpi(spark, d).star, FIXTURE_TODAY).select("order_id", "user_id", "status", "created_at")


ORACLE["snapshot_orders"] = with_("o") + f"""
SELECT order_id, user_id, status, {ts('created_at')} AS created_at FROM o
WHERE created_at < TIMESTAMP '{TODAY} 00:00:00'"""


@register("snapshot_items")
def snapshot_items(spark, d):
    """B2: items following their kept order."""
    return S.snapshot_items(kpi(spark, d).star, FIXTURE_TODAY).select(
        "order_id", "line_number", "product_id", "supplier_id", "sale_price", "created_at")


ORACLE["snapshot_items"] = with_("o", "oi") + f"""
SELECT order_id, line_number, product_id, supplier_id, ROUND(CAST(sale_price AS DOUBLE), 6) AS sale_price,
       {ts('created_at')} AS created_at
FROM oi WHERE order_id IN (SELECT order_id FROM o WHERE created_at < TIMESTAMP '{TODAY} 00:00:00')"""


@register("snapshot_users")
def snapshot_users(spark, d):
    """Users created before the cutoff or owning a kept order."""
    return S.snapshot_users(kpi(spark, d).star, FIXTURE_TODAY).select("id", "name", "country", "traffic_source")


ORACLE["snapshot_users"] = with_("o", "u") + f"""
SELECT id, name, country, traffic_source FROM u
WHERE id IN (SELECT user_id FROM o WHERE created_at < TIMESTAMP '{TODAY} 00:00:00')"""


@register("snapshot_inventory")
def snapshot_inventory(spark, d):
    """Products referenced by an item of a kept order (nested IN)."""
    return S.snapshot_products(kpi(spark, d).star, FIXTURE_TODAY).select("id", "category", "brand", "department")


ORACLE["snapshot_inventory"] = with_("o", "oi", "p") + f"""
SELECT id, category, brand, department FROM p
WHERE id IN (SELECT product_id FROM oi WHERE order_id IN
             (SELECT order_id FROM o WHERE created_at < TIMESTAMP '{TODAY} 00:00:00'))"""


@register("snapshot_users_opening")
def snapshot_users_opening(spark, d):
    """Users first seen before an early cutoff or owning an order from before it (existence join)."""
    u = S.opening_users(kpi(spark, d).star, OPENING_CUTOFF, OPENING_SHIFT_DAYS)
    return u.select("id", "name", "country", "traffic_source", "created_at")


ORACLE["snapshot_users_opening"] = with_("o", "u", extra=f"""
seen AS (SELECT user_id, MIN(ts) - INTERVAL {OPENING_SHIFT_DAYS} DAY AS created_at FROM events GROUP BY 1)""") + f"""
SELECT id, name, country, traffic_source, {ts('created_at')} AS created_at FROM u LEFT JOIN seen ON user_id = id
WHERE created_at < TIMESTAMP '{OPENING_CUTOFF} 00:00:00'
   OR id IN (SELECT user_id FROM o WHERE created_at < TIMESTAMP '{OPENING_CUTOFF} 00:00:00')"""


@register("snapshot_inventory_opening")
def snapshot_inventory_opening(spark, d):
    """Products first stamped before an early cutoff or referenced by an item of an order from before it."""
    return S.opening_inventory(kpi(spark, d).star, OPENING_CUTOFF).select("id", "category", "brand", "department", "created_at")


ORACLE["snapshot_inventory_opening"] = with_("o", "oi", "p", extra=f"""
stamped AS (SELECT product_id, MIN(created_at) AS created_at FROM oi GROUP BY 1)""") + f"""
SELECT id, category, brand, department, {ts('created_at')} AS created_at FROM p LEFT JOIN stamped ON product_id = id
WHERE created_at < TIMESTAMP '{OPENING_CUTOFF} 00:00:00'
   OR id IN (SELECT product_id FROM oi WHERE order_id IN
             (SELECT order_id FROM o WHERE o.created_at < TIMESTAMP '{OPENING_CUTOFF} 00:00:00'))"""


@register("required_values_check")
def required_values_check(spark, d):
    """The event types the funnel flags need are present."""
    return S.required_values(kpi(spark, d).star.events, "event_type", REQUIRED_EVENT_TYPES, spark)


ORACLE["required_values_check"] = """
SELECT r.event_type, COALESCE(c.n, 0) AS n, c.n IS NOT NULL AS present
FROM (VALUES ('view'), ('click'), ('purchase')) r(event_type)
LEFT JOIN (SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1) c USING (event_type)"""


@register("event_type_counts")
def event_type_counts(spark, d):
    """Event-type histogram."""
    return S.value_histogram(kpi(spark, d).star.events, "event_type")


ORACLE["event_type_counts"] = "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type"


@register("snapshot_checks")
def snapshot_checks(spark, d):
    """Max order time, orphan counts and the session purchase rate."""
    k = kpi(spark, d)
    return S.snapshot_checks(k.star, k.sessions, FIXTURE_TODAY)


ORACLE["snapshot_checks"] = with_("o", "oi", "p", "u", "sess", extra=f"""
ko AS (SELECT * FROM o WHERE created_at < TIMESTAMP '{TODAY} 00:00:00'),
ki AS (SELECT * FROM oi WHERE order_id IN (SELECT order_id FROM ko))""") + f"""
SELECT (SELECT {ts('MAX(created_at)')} FROM ko) AS max_order_created_at,
       (SELECT COUNT(*) FROM ki WHERE order_id NOT IN (SELECT order_id FROM ko)) AS order_items_without_order,
       (SELECT COUNT(*) FROM ki WHERE product_id NOT IN (SELECT id FROM p)) AS order_items_without_product,
       (SELECT COUNT(*) FROM ko WHERE user_id NOT IN (SELECT id FROM u)) AS orders_without_user,
       (SELECT ROUND(AVG(CAST(purchased AS INT)), 6) FROM sess) AS session_purchase_rate"""
