"""Registered queries: profiling and data quality (H1-H32), with oracle SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from kpilens.config import FIXTURE_TODAY
from kpilens.operators import profile as H
from kpilens.operators.stamps import LONGEST, order_stamps
from kpilens.plans.registry import kpi, register
from kpilens.plans.sql_base import TODAY, with_
from kpilens.sources.tables import SCHEMAS

ORACLE: dict[str, str] = {}


def _star(spark, d):
    return kpi(spark, d).star


@register("key_uniqueness")
def key_uniqueness(spark, d):
    """H1: rows and distinct keys per logical table."""
    k = kpi(spark, d)
    s = k.star
    return H.key_uniqueness({
        "orders": (s.orders, F.col("order_id")),
        "order_items": (s.order_items, F.concat_ws("-", F.col("order_id").cast("string"),
                                                   F.col("line_number").cast("string"))),
        "products": (s.products, F.col("id")),
        "users": (s.users, F.col("id")),
        "distribution_centers": (s.distribution_centers, F.col("id")),
        "sessions": (k.sessions, F.col("session_id")),
        "events": (s.events, F.col("event_id")),
    })


def _ku(t: str, key: str, src: str) -> str:
    return (f"SELECT '{t}' AS table_name, COUNT(*) AS rows, COUNT(DISTINCT {key}) AS distinct_keys, "
            f"COUNT(*) = COUNT(DISTINCT {key}) AS \"unique\" FROM {src}")


ORACLE["key_uniqueness"] = with_("o", "oi", "p", "u", "dc", "sess") + "\nUNION ALL\n".join([
    _ku("orders", "order_id", "o"),
    _ku("order_items", "CAST(order_id AS VARCHAR) || '-' || CAST(line_number AS VARCHAR)", "oi"),
    _ku("products", "id", "p"), _ku("users", "id", "u"), _ku("distribution_centers", "id", "dc"),
    _ku("sessions", "session_id", "sess"), _ku("events", "event_id", "events")])


@register("referential_integrity")
def referential_integrity(spark, d):
    """H2: foreign keys pointing at nothing, orders without items, users without orders."""
    k = kpi(spark, d)
    s = k.star
    raw = s.raw
    return H.referential_integrity([
        ("order_items.order_id -> orders", s.order_items, "order_id", s.orders, "order_id"),
        ("order_items.product_id -> products", s.order_items, "product_id", s.products, "id"),
        ("order_items.supplier_id -> distribution_centers", s.order_items, "supplier_id",
         s.distribution_centers, "id"),
        ("orders.user_id -> users", s.orders, "user_id", s.users, "id"),
        ("customer.c_nationkey -> nation", raw["customer"], "c_nationkey", raw["nation"], "n_nationkey"),
        ("supplier.s_nationkey -> nation", raw["supplier"], "s_nationkey", raw["nation"], "n_nationkey"),
        ("sessions.user_id -> users (non-null only)", k.sessions, "user_id", s.users, "id"),
        ("orders with zero items", s.orders, "order_id", s.order_items, "order_id"),
        ("users with zero orders", s.users, "id", s.orders, "user_id"),
    ])


def _ri(label: str, child: str, fk: str, parent: str, pk: str) -> str:
    return (f"SELECT '{label}' AS \"check\", COUNT(*) AS violations FROM {child} "
            f"WHERE {fk} IS NOT NULL AND {fk} NOT IN (SELECT {pk} FROM {parent} WHERE {pk} IS NOT NULL)")


ORACLE["referential_integrity"] = with_("o", "oi", "p", "u", "dc", "sess") + "\nUNION ALL\n".join([
    _ri("order_items.order_id -> orders", "oi", "order_id", "o", "order_id"),
    _ri("order_items.product_id -> products", "oi", "product_id", "p", "id"),
    _ri("order_items.supplier_id -> distribution_centers", "oi", "supplier_id", "dc", "id"),
    _ri("orders.user_id -> users", "o", "user_id", "u", "id"),
    _ri("customer.c_nationkey -> nation", "customer", "c_nationkey", "nation", "n_nationkey"),
    _ri("supplier.s_nationkey -> nation", "supplier", "s_nationkey", "nation", "n_nationkey"),
    _ri("sessions.user_id -> users (non-null only)", "sess", "user_id", "u", "id"),
    _ri("orders with zero items", "o", "order_id", "oi", "order_id"),
    _ri("users with zero orders", "u", "id", "o", "user_id")])

#: Tables derived from the stored ones, with their SQL names; their columns are profiled besides all stored columns.
NULL_DERIVED = {
    "products": ("p", ("id", "cost", "category", "brand", "department", "name", "retail_price")),
    "users": ("u", ("id", "name", "country", "traffic_source", "acctbal")),
    "sessions": ("sess", ("session_id", "user_id", "traffic_source", "browser", "started_at", "n_events")),
    "order_stamps": ("st", ("order_id", "status", "created_at", "shipped_at", "delivered_at", "returned_at")),
}


@register("null_profile")
def null_profile(spark, d):
    """H3: null count and % of every column of every table, where there are any: one aggregate a table."""
    k = kpi(spark, d)
    derived = {"products": k.star.products, "users": k.star.users, "sessions": k.sessions, "order_stamps": order_stamps(k.star)}
    return H.null_profile(k.star.raw | {t: derived[t].select(*cols) for t, (_, cols) in NULL_DERIVED.items()})


def _null_oracle() -> str:
    cols = [(t, t, f.name) for t, schema in SCHEMAS.items() for f in schema.fields]
    cols += [(t, src, c) for t, (src, names) in NULL_DERIVED.items() for c in names]
    return with_("o", "oi", "p", "u", "sess", extra=STAMPS_CTE) + "SELECT * FROM (\n" + "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS nulls, "
        f"ROUND(100.0 * (COUNT(*) - COUNT({c})) / COUNT(*), 6) AS pct FROM {src}" for t, src, c in cols) + "\n) t WHERE nulls > 0"


@register("department_list")
def department_list(spark, d):
    """H4: products per department in one string."""
    return H.department_list(_star(spark, d).products)


ORACLE["department_list"] = with_("p") + """
SELECT string_agg(department || ':' || CAST(n AS VARCHAR), '  ' ORDER BY department) AS departments
FROM (SELECT department, COUNT(*) AS n FROM p GROUP BY 1) t"""


@register("cardinalities")
def cardinalities(spark, d):
    """H5: distinct categories, brands, products and centres."""
    return H.cardinalities(_star(spark, d))


ORACLE["cardinalities"] = with_("p", "dc") + """
SELECT (SELECT COUNT(DISTINCT category) FROM p) AS categories, (SELECT COUNT(DISTINCT brand) FROM p) AS brands,
       (SELECT COUNT(*) FROM p) AS products, (SELECT COUNT(*) FROM dc) AS centres,
       (SELECT COUNT(DISTINCT name) FROM dc) AS centre_names"""

ITEMS_CTE = """it AS (SELECT oi.product_id, oi.sale_price, oi.quantity, p.category, p.department, p.brand,
                      p.retail_price, p.cost FROM oi JOIN p ON p.id = oi.product_id)"""


@register("top_categories")
def top_categories(spark, d):
    """H6: top 10 categories by all-time revenue."""
    return H.top_categories(H.sold_items(_star(spark, d)))


ORACLE["top_categories"] = with_("oi", "p", extra=ITEMS_CTE) + """
SELECT category, ROUND(CAST(rev AS DOUBLE), 6) AS revenue, items,
       ROUND(100 * CAST(rev AS DOUBLE) / CAST(SUM(rev) OVER () AS DOUBLE), 6) AS share_pct,
       ROUND(CAST(rev AS DOUBLE) / items, 6) AS avg_price
FROM (SELECT category, SUM(sale_price) AS rev, COUNT(*) AS items FROM it GROUP BY 1) g
ORDER BY rev DESC, category LIMIT 10"""


@register("department_share")
def department_share(spark, d):
    """H7: department share of revenue."""
    return H.department_share(H.sold_items(_star(spark, d)))


ORACLE["department_share"] = with_("oi", "p", extra=ITEMS_CTE) + """
SELECT department, ROUND(100 * CAST(rev AS DOUBLE) / CAST(SUM(rev) OVER () AS DOUBLE), 6) AS share_pct
FROM (SELECT department, SUM(sale_price) AS rev FROM it GROUP BY 1) g"""


@register("brand_pareto")
def brand_pareto(spark, d):
    """H8: how many brands make 50 % / 80 % of revenue."""
    return H.brand_pareto(H.sold_items(_star(spark, d)))


ORACLE["brand_pareto"] = with_("oi", "p", extra=ITEMS_CTE + """,
b AS (SELECT brand, SUM(sale_price) AS rev FROM it WHERE brand IS NOT NULL GROUP BY 1),
c AS (SELECT brand, SUM(rev) OVER (ORDER BY rev DESC, brand ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
      FROM b)""") + """
SELECT COUNT(*) AS brands,
       SUM(CASE WHEN CAST(cum AS DOUBLE) / (SELECT CAST(SUM(sale_price) AS DOUBLE) FROM it) < 0.5 THEN 1 ELSE 0 END) + 1
           AS brands_for_50pct,
       SUM(CASE WHEN CAST(cum AS DOUBLE) / (SELECT CAST(SUM(sale_price) AS DOUBLE) FROM it) < 0.8 THEN 1 ELSE 0 END) + 1
           AS brands_for_80pct
FROM c"""


@register("top_brands")
def top_brands(spark, d):
    """H8: the 10 brands with the most revenue, with shares and running shares."""
    return H.top_brands(H.sold_items(_star(spark, d)))


ORACLE["top_brands"] = with_("oi", "p", extra=ITEMS_CTE + """,
b AS (SELECT brand, SUM(sale_price) AS rev FROM it WHERE brand IS NOT NULL GROUP BY 1),
c AS (SELECT brand, rev, ROW_NUMBER() OVER (ORDER BY rev DESC, brand) AS rank,
             SUM(rev) OVER (ORDER BY rev DESC, brand ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM b),
t AS (SELECT CAST(SUM(sale_price) AS DOUBLE) AS total FROM it)""") + """
SELECT rank, brand, CAST(rev AS DOUBLE) AS revenue, ROUND(100 * CAST(rev AS DOUBLE) / total, 6) AS share_pct,
       ROUND(100 * CAST(cum AS DOUBLE) / total, 6) AS cum_share_pct
FROM c CROSS JOIN t WHERE rank <= 10"""


@register("single_sale_brands")
def single_sale_brands(spark, d):
    """H9: brands sold exactly once."""
    return H.single_sale_brands(H.sold_items(_star(spark, d)))


ORACLE["single_sale_brands"] = with_("oi", "p", extra=ITEMS_CTE) + """
SELECT SUM(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS single_sale_brands
FROM (SELECT brand, COUNT(*) AS n FROM it WHERE brand IS NOT NULL GROUP BY 1) t"""


@register("price_checks")
def price_checks(spark, d):
    """H10 (R18): list-price agreement and impossible prices."""
    return H.price_checks(H.sold_items(_star(spark, d)))


ORACLE["price_checks"] = with_("oi", "p", extra=ITEMS_CTE) + """
SELECT ROUND(100 * AVG(CASE WHEN ROUND(CAST(sale_price AS DOUBLE), 2) = ROUND(quantity * retail_price, 2)
                            THEN 1 ELSE 0 END), 6) AS pct_sale_eq_retail,
       SUM(CASE WHEN sale_price <= 0 THEN 1 ELSE 0 END) AS sale_price_nonpos,
       SUM(CASE WHEN cost <= 0 THEN 1 ELSE 0 END) AS cost_nonpos,
       SUM(CASE WHEN cost > sale_price THEN 1 ELSE 0 END) AS cost_above_price
FROM it"""


@register("price_quantiles")
def price_quantiles(spark, d):
    """Sale price p5..p99 (exact, linear)."""
    return H.price_quantiles(H.sold_items(_star(spark, d)))


ORACLE["price_quantiles"] = with_("oi", "p", extra=ITEMS_CTE) + ", ".join(
    ["SELECT " + ", ".join(f"ROUND(quantile_cont(CAST(sale_price AS DOUBLE), {p}), 6) AS {n}"
                           for n, p in H.PRICE_PROBS.items())]) + " FROM it"


@register("margin_spread")
def margin_spread(spark, d):
    """Min / median / max of 1 - cost / price."""
    return H.margin_spread(H.sold_items(_star(spark, d)))


ORACLE["margin_spread"] = with_("oi", "p", extra=ITEMS_CTE) + """
SELECT ROUND(MIN(m), 6) AS min_margin, ROUND(MAX(m), 6) AS max_margin, ROUND(quantile_cont(m, 0.5), 6) AS median_margin
FROM (SELECT 1 - CAST(cost AS DOUBLE) / NULLIF(CAST(sale_price AS DOUBLE), 0) AS m FROM it) t"""


@register("never_sold")
def never_sold(spark, d):
    """Products never sold."""
    return H.never_sold(_star(spark, d))


ORACLE["never_sold"] = with_("oi", "p") + """
SELECT (SELECT COUNT(*) FROM p WHERE id NOT IN (SELECT product_id FROM oi)) AS never_sold,
       (SELECT COUNT(*) FROM p) AS products"""


@register("value_shares")
def value_shares(spark, d):
    """Country (top 8), acquisition source and order status shares."""
    return H.value_shares(_star(spark, d))


def _shares(src: str, col: str, attr: str, top: int | None = None) -> str:
    lim = f" WHERE rank <= {top}" if top else ""
    return f"""SELECT * FROM (SELECT '{attr}' AS attribute, {col} AS value,
       ROUND(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 6) AS share_pct,
       ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, {col}) AS rank FROM {src} GROUP BY {col}) t{lim}"""


ORACLE["value_shares"] = with_("o", "u") + "\nUNION ALL\n".join([
    _shares("u", "country", "country", 8), _shares("u", "traffic_source", "acq_source"),
    _shares("o", "status", "order_status")])


@register("numeric_summary")
def numeric_summary(spark, d):
    """Min / median / max of the customers' account balance (the fixtures have no age)."""
    return H.numeric_summary(_star(spark, d).users, "acctbal")


ORACLE["numeric_summary"] = with_("u") + """
SELECT ROUND(MIN(acctbal), 6) AS min, ROUND(MAX(acctbal), 6) AS max, ROUND(quantile_cont(acctbal, 0.5), 6) AS median
FROM u"""


@register("rows_per_year")
def rows_per_year(spark, d):
    """Orders and items per year."""
    return H.rows_per_year(_star(spark, d))


ORACLE["rows_per_year"] = with_("o", "oi") + """
SELECT 'orders' AS table_name, year(created_at) AS year, COUNT(*) AS n FROM o GROUP BY 2
UNION ALL SELECT 'order_items', year(created_at), COUNT(*) FROM oi GROUP BY 2"""


@register("orders_per_buyer")
def orders_per_buyer(spark, d):
    """Buyers with 1, 2, 3+ orders."""
    return H.orders_per_buyer(_star(spark, d).orders)


ORACLE["orders_per_buyer"] = with_("o") + """
SELECT ROUND(100 * AVG(CASE WHEN n = 1 THEN 1 ELSE 0 END), 6) AS pct_1,
       ROUND(100 * AVG(CASE WHEN n = 2 THEN 1 ELSE 0 END), 6) AS pct_2,
       ROUND(100 * AVG(CASE WHEN n >= 3 THEN 1 ELSE 0 END), 6) AS pct_3plus, MAX(n) AS max_orders
FROM (SELECT user_id, COUNT(*) AS n FROM o GROUP BY 1) t"""


@register("order_before_parent")
def order_before_parent(spark, d):
    """Items stamped before their order (theta residual on an equi-join)."""
    return H.order_before_parent(_star(spark, d))


ORACLE["order_before_parent"] = with_("o", "oi") + """
SELECT COUNT(*) AS items_before_order FROM oi JOIN o ON o.order_id = oi.order_id WHERE oi.created_at < o.created_at"""


@register("duplicate_values")
def duplicate_values(spark, d):
    """H19 (R19): duplicated attribute values (not identifiers)."""
    s = _star(spark, d)
    return H.duplicate_values([("users", s.users, "name"), ("users", s.users, "acctbal"),
                               ("products", s.products, "name"), ("orders", s.orders, "total_price")])


ORACLE["duplicate_values"] = with_("o", "p", "u") + """
SELECT 'users' AS table_name, 'name' AS column_name, COUNT(*) - COUNT(DISTINCT name) AS duplicates FROM u
UNION ALL SELECT 'users', 'acctbal', COUNT(*) - COUNT(DISTINCT acctbal) FROM u
UNION ALL SELECT 'products', 'name', COUNT(*) - COUNT(DISTINCT name) FROM p
UNION ALL SELECT 'orders', 'total_price', COUNT(*) - COUNT(DISTINCT total_price) FROM o"""


@register("date_span")
def date_span(spark, d):
    """First and last order."""
    return H.date_span(_star(spark, d).orders)


ORACLE["date_span"] = with_("o") + """
SELECT strftime(MIN(created_at), '%Y-%m-%d %H:%M:%S') AS first_order,
       strftime(MAX(created_at), '%Y-%m-%d %H:%M:%S') AS last_order FROM o"""


@register("stored_count_check")
def stored_count_check(spark, d):
    """Stored order total vs its items; items per order."""
    return H.stored_count_check(_star(spark, d))


ORACLE["stored_count_check"] = with_("o", "oi") + """
SELECT ROUND(100 * AVG(CASE WHEN ROUND(o.total_price, 2) = CAST(t.s AS DOUBLE) THEN 1 ELSE 0 END), 6)
           AS pct_total_matches_items,
       ROUND(AVG(t.n), 6) AS mean_items_per_order, MAX(t.n) AS max_items_per_order
FROM o LEFT JOIN (SELECT order_id, COUNT(*) AS n, SUM(sale_price) AS s FROM oi GROUP BY 1) t ON t.order_id = o.order_id"""

def later_sql(since: str, step: str, key: str = "order_id") -> str:
    drawn = f"CAST('0x' || substr(md5('{step}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"
    return f"{since} + to_seconds({drawn} % {LONGEST[step] * 86_400 + 1})"


STAMPS_CTE = f"""st0 AS (SELECT o.*, f.shipped_at FROM o LEFT JOIN (SELECT order_id, MIN(created_at) AS shipped_at FROM oi GROUP BY 1) f
         ON f.order_id = o.order_id),
st1 AS (SELECT *, CASE WHEN status IN ('Complete', 'Returned') THEN {later_sql('shipped_at', 'delivered')} END AS delivered_at FROM st0),
st AS (SELECT *, CASE WHEN status = 'Returned' THEN {later_sql('delivered_at', 'returned')} END AS returned_at FROM st1)"""


@register("status_consistency")
def status_consistency(spark, d):
    """Six status / timestamp rules."""
    return H.status_consistency(order_stamps(_star(spark, d)))


ORACLE["status_consistency"] = with_("o", "oi", extra=STAMPS_CTE) + "\nUNION ALL\n".join(
    f"SELECT '{name}' AS rule, SUM(CASE WHEN {cond} THEN 1 ELSE 0 END) AS violations FROM st" for name, cond in [
        ("sent_but_no_ship_time",
         "status IN ('Shipped', 'Complete', 'Returned') AND shipped_at IS NULL"),
        ("done_but_no_delivery_time", "status IN ('Complete', 'Returned') AND delivered_at IS NULL"),
        ("returned_but_no_return_time", "status = 'Returned' AND returned_at IS NULL"),
        ("not_sent_but_ship_time", "status IN ('Processing', 'Cancelled') AND shipped_at IS NOT NULL"),
        ("under_way_but_delivery_time", "status = 'Shipped' AND delivered_at IS NOT NULL"),
        ("kept_but_return_time", "status <> 'Returned' AND returned_at IS NOT NULL")])


@register("gap_profile")
def gap_profile(spark, d):
    """Created -> shipped -> delivered -> returned gaps in days."""
    return H.gap_profile(_star(spark, d), order_stamps(_star(spark, d)))


ORACLE["gap_profile"] = with_("o", "oi", extra=STAMPS_CTE) + """
SELECT gap, SUM(CASE WHEN days < 0 THEN 1 ELSE 0 END) AS negative, ROUND(MAX(days), 6) AS max_days,
       ROUND(quantile_cont(days, 0.5), 6) AS median_days, ROUND(quantile_cont(days, 0.95), 6) AS p95_days
FROM (SELECT 'created -> shipped' AS gap, (epoch_us(oi.created_at) - epoch_us(o.created_at)) / 86400e6 AS days
      FROM oi JOIN o ON o.order_id = oi.order_id
      UNION ALL SELECT 'shipped -> delivered', (epoch_us(delivered_at) - epoch_us(shipped_at)) / 86400e6 FROM st
      UNION ALL SELECT 'delivered -> returned', (epoch_us(returned_at) - epoch_us(delivered_at)) / 86400e6 FROM st) t
WHERE days IS NOT NULL GROUP BY gap"""


@register("after_cutoff")
def after_cutoff(spark, d):
    """Stamps at or after the cutoff."""
    return H.after_cutoff(order_stamps(_star(spark, d)), FIXTURE_TODAY)


ORACLE["after_cutoff"] = with_("o", "oi", extra=STAMPS_CTE) + f"""
SELECT SUM(CASE WHEN shipped_at >= TIMESTAMP '{TODAY} 00:00:00' THEN 1 ELSE 0 END) AS shipped,
       SUM(CASE WHEN delivered_at >= TIMESTAMP '{TODAY} 00:00:00' THEN 1 ELSE 0 END) AS delivered,
       SUM(CASE WHEN returned_at >= TIMESTAMP '{TODAY} 00:00:00' THEN 1 ELSE 0 END) AS returned
FROM st"""


@register("item_order_agreement")
def item_order_agreement(spark, d):
    """Item status and stamps against their order's (the stored status letters; the order's ship time is
    its first item's)."""
    star = _star(spark, d)
    letters = star.raw["orders"].select(F.col("o_orderkey").alias("order_id"), F.col("o_orderstatus").alias("status"))
    orders = order_stamps(star).drop("status").join(letters, "order_id")
    return H.item_order_agreement(star.order_items.withColumn("status", F.col("line_status")), orders)


ORACLE["item_order_agreement"] = with_("o", "oi", extra=STAMPS_CTE) + """
SELECT ROUND(100 * AVG(CASE WHEN oi.line_status = r.o_orderstatus THEN 1 ELSE 0 END), 6) AS pct_status_equal,
       ROUND(100 * AVG(CASE WHEN oi.created_at = st.created_at THEN 1 ELSE 0 END), 6) AS pct_created_equal,
       ROUND(100 * AVG(CASE WHEN strftime(oi.created_at, '%Y-%m') = strftime(st.created_at, '%Y-%m') THEN 1 ELSE 0 END), 6)
           AS pct_same_month,
       ROUND(100 * AVG(CASE WHEN oi.created_at IS NOT DISTINCT FROM st.shipped_at THEN 1 ELSE 0 END), 6) AS pct_shipped_equal
FROM oi JOIN st ON st.order_id = oi.order_id JOIN orders r ON r.o_orderkey = oi.order_id"""


@register("inventory_counts")
def inventory_counts(spark, d):
    """Products, those sold, and those referenced by items."""
    return H.inventory_counts(_star(spark, d))


ORACLE["inventory_counts"] = with_("o", "oi", "p") + """
SELECT (SELECT COUNT(*) FROM p) AS products,
       (SELECT COUNT(DISTINCT product_id) FROM oi JOIN o ON o.order_id = oi.order_id
         WHERE COALESCE(o.status NOT IN ('Cancelled', 'Returned'), true)) AS sold,
       (SELECT COUNT(DISTINCT product_id) FROM oi) AS referenced"""


@register("cost_agreement")
def cost_agreement(spark, d):
    """Unit price of items against the product list price (4 decimals)."""
    return H.cost_agreement(_star(spark, d))


ORACLE["cost_agreement"] = with_("oi", "p") + """
SELECT ROUND(100 * AVG(CASE WHEN ROUND(CAST(oi.sale_price AS DOUBLE) / NULLIF(oi.quantity, 0), 4) = ROUND(p.retail_price, 4)
                            THEN 1 ELSE 0 END), 6) AS pct_unit_price_equal
FROM oi JOIN p ON p.id = oi.product_id"""


@register("session_profile")
def session_profile(spark, d):
    """Sessions, anonymous %, purchased %, events per session."""
    return H.session_profile(kpi(spark, d).sessions)


ORACLE["session_profile"] = with_("sess") + """
SELECT COUNT(*) AS sessions, ROUND(100 * AVG(CASE WHEN user_id IS NULL THEN 1 ELSE 0 END), 6) AS anonymous_pct,
       ROUND(100 * AVG(CAST(purchased AS INT)), 6) AS purchased_pct, MAX(n_events) AS max_events,
       ROUND(quantile_cont(CAST(n_events AS DOUBLE), 0.5), 6) AS median_events
FROM sess"""


@register("purchase_rate_by_period")
def purchase_rate_by_period(spark, d):
    """H29 (R15): purchase rate and non-purchase sessions per period."""
    return H.purchase_rate_by_period(kpi(spark, d).sessions)


ORACLE["purchase_rate_by_period"] = with_("sess") + """
SELECT period, ROUND(AVG(CAST(purchased AS INT)), 6) AS purchase_rate,
       SUM(CASE WHEN NOT purchased THEN 1 ELSE 0 END) AS non_purchase_sessions
FROM sess GROUP BY period"""


@register("edge_months")
def edge_months(spark, d):
    """First 3 and last 3 months of orders with items."""
    return H.edge_months(kpi(spark, d).fact)


ORACLE["edge_months"] = with_("fact", extra="""
m AS (SELECT month, COUNT(DISTINCT order_id) AS orders, ROUND(CAST(SUM(sale_price) AS DOUBLE), 6) AS revenue
      FROM fact GROUP BY 1)""") + """
SELECT * FROM (SELECT 'first' AS edge, * FROM m ORDER BY month LIMIT 3)
UNION ALL SELECT * FROM (SELECT 'last' AS edge, * FROM m ORDER BY month DESC LIMIT 3)"""


@register("daily_tail")
def daily_tail(spark, d):
    """Orders per day over the last week before the cutoff."""
    return H.daily_tail(_star(spark, d).orders, FIXTURE_TODAY)


ORACLE["daily_tail"] = with_("o") + f"""
SELECT strftime(created_at, '%Y-%m-%d') AS day, COUNT(*) AS n FROM o
WHERE created_at >= TIMESTAMP '{TODAY} 00:00:00' - INTERVAL 7 DAY AND created_at < TIMESTAMP '{TODAY} 00:00:00'
GROUP BY 1"""


@register("centre_list")
def centre_list(spark, d):
    """Centres with their region and supplier count."""
    return H.centre_list(_star(spark, d))


ORACLE["centre_list"] = with_("dc") + "SELECT name, region, COUNT(*) AS suppliers FROM dc GROUP BY 1, 2"


ORACLE["null_profile"] = _null_oracle()
