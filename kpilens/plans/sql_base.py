"""Building blocks of the independent DuckDB oracle SQL.

The same logical star schema (FIXTURES.md section 3) written a second time, in
plain ANSI SQL over the stored tables. `with_(...)` assembles a WITH clause.
"""

from __future__ import annotations

TODAY = "2001-08-01"
TODAY_MONTH = TODAY[:7]
DIMS = ("customer_type", "acq_source", "country", "department", "category", "brand", "dist_center")

CTE = {
    "o": """o AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'Cancelled'
              WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Returned'
              WHEN o_orderstatus = 'F' THEN 'Complete'
              WHEN o_orderstatus = 'O' THEN 'Shipped'
              ELSE 'Processing' END AS status,
         o_orderdate AS created_at, o_totalprice AS total_price
  FROM orders)""",
    "oi": """oi AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
         l_suppkey AS supplier_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS sale_price,
         l_quantity AS quantity, l_linestatus AS line_status, l_shipdate AS created_at
  FROM lineitem)""",
    "p": """p AS (
  SELECT p_partkey AS id, CAST(p_retailprice AS DECIMAL(18,2)) AS cost, p_type AS category,
         NULLIF(p_brand, 'Brand#13') AS brand,
         CASE WHEN p_size <= 25 THEN 'Small' ELSE 'Large' END AS department,
         p_name AS name, p_retailprice AS retail_price
  FROM part)""",
    "u": """u AS (
  SELECT c_custkey AS id, c_name AS name, n_name AS country, c_mktsegment AS traffic_source,
         c_acctbal AS acctbal
  FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey)""",
    "dc": """dc AS (
  SELECT s_suppkey AS id, n_name AS name, r_name AS region
  FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey
                LEFT JOIN region ON r_regionkey = n_regionkey)""",
    "fo": """fo AS (
  SELECT user_id, MIN(date_trunc('second', created_at)) AS first_at
  FROM o WHERE order_id IN (SELECT order_id FROM oi) GROUP BY user_id)""",
    "fact": """fact AS (
  SELECT oi.order_id, o.user_id, oi.sale_price, strftime(o.created_at, '%Y-%m') AS month,
         o.created_at AS order_created_at, o.status AS order_status, p.cost,
         COALESCE(p.category, '(unknown)') AS category, COALESCE(p.brand, '(unknown)') AS brand,
         COALESCE(p.department, '(unknown)') AS department, COALESCE(dc.name, '(unknown)') AS dist_center,
         COALESCE(u.traffic_source, '(unknown)') AS acq_source, COALESCE(u.country, '(unknown)') AS country,
         CASE WHEN date_trunc('second', o.created_at) = fo.first_at THEN 'new' ELSE 'returning' END
             AS customer_type,
         oi.sale_price - p.cost AS profit,
         COALESCE(o.status IN ('Cancelled', 'Returned'), false) AS lost,
         CASE WHEN COALESCE(o.status IN ('Cancelled', 'Returned'), false) THEN CAST(0 AS DECIMAL(18,2))
              ELSE oi.sale_price END AS net_sale_price,
         oi.created_at AS item_created_at
  FROM oi JOIN o ON o.order_id = oi.order_id
          JOIN p ON p.id = oi.product_id
          JOIN dc ON dc.id = oi.supplier_id
          JOIN u ON u.id = o.user_id
          LEFT JOIN fo ON fo.user_id = o.user_id)""",
    "mcore": f"""mcore AS (
  SELECT month, SUM(sale_price) AS revenue_d, SUM(net_sale_price) AS net_d,
         COUNT(DISTINCT order_id) AS orders, COUNT(*) AS items, SUM(profit) AS profit_d
  FROM fact WHERE month < '{TODAY_MONTH}' GROUP BY month)""",
    "monthly": """monthly AS (
  SELECT month, CAST(revenue_d AS DOUBLE) AS revenue, CAST(net_d AS DOUBLE) AS net_revenue, orders, items,
         CAST(profit_d AS DOUBLE) AS profit,
         CAST(revenue_d AS DOUBLE) / NULLIF(orders, 0) AS aov,
         CAST(items AS DOUBLE) / NULLIF(orders, 0) AS items_per_order,
         CAST(profit_d AS DOUBLE) / NULLIF(CAST(revenue_d AS DOUBLE), 0) AS margin,
         (CAST(revenue_d AS DOUBLE) - LAG(CAST(revenue_d AS DOUBLE)) OVER (ORDER BY month))
           / NULLIF(LAG(CAST(revenue_d AS DOUBLE)) OVER (ORDER BY month), 0) AS mom
  FROM mcore)""",
    "months": """months AS (
  SELECT month, ROW_NUMBER() OVER (ORDER BY month) AS idx FROM monthly)""",
    "per": """per AS (
  SELECT m.month, m.idx, m.idx = n.n AS cur1, m.idx = n.n - 1 AS prev1,
         m.idx > n.n - 3 AS cur3, m.idx BETWEEN n.n - 5 AND n.n - 3 AS prev3
  FROM months m CROSS JOIN (SELECT MAX(idx) AS n FROM months) n)""",
    "ords": """ords AS (
  SELECT DISTINCT order_id, month, order_status FROM fact)""",
    "leak": f"""leak AS (
  SELECT month, AVG(CASE WHEN order_status = 'Cancelled' THEN 1 ELSE 0 END) AS cancelled,
         AVG(CASE WHEN order_status = 'Returned' THEN 1 ELSE 0 END) AS returned
  FROM ords WHERE order_status IS NOT NULL AND month < '{TODAY_MONTH}' GROUP BY month)""",
    "ev": """ev AS (
  SELECT event_id, ts, user_id, event_type, props,
         CASE WHEN LAG(ts) OVER w IS NULL
                OR epoch_us(ts) - epoch_us(LAG(ts) OVER w) > CAST(21600000000 AS BIGINT) THEN 1 ELSE 0 END AS is_start
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""",
    "evs": """evs AS (
  SELECT *, SUM(is_start) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_no
  FROM ev)""",
    "sess": """sess AS (
  SELECT CAST(user_id AS VARCHAR) || '-' || CAST(session_no AS VARCHAR) AS session_id,
         CASE WHEN user_id % 10 <> 0 THEN user_id END AS user_id,
         'S' || CAST(arg_min(CAST(json_extract_string(props, '$.k') AS BIGINT), (ts, event_id)) % 5 AS VARCHAR)
             AS traffic_source,
         'B' || CAST(arg_min(CAST(json_extract_string(props, '$.k') AS BIGINT), (ts, event_id)) % 4 AS VARCHAR)
             AS browser,
         MIN(ts) AS started_at, COUNT(*) AS n_events,
         bool_or(event_type = 'view') AS saw_product, bool_or(event_type = 'click') AS added_to_cart,
         bool_or(event_type = 'purchase') AS purchased,
         strftime(date_trunc('week', MIN(ts)), '%Y-%m-%d') AS period
  FROM evs GROUP BY user_id, session_no)""",
    "sper": """sper AS (
  SELECT period, ROW_NUMBER() OVER (ORDER BY period) AS idx
  FROM (SELECT DISTINCT period FROM sess) t
  WHERE period < (SELECT MAX(period) FROM sess))""",
    "sp": """sp AS (
  SELECT MAX(CASE WHEN idx = n THEN period END) AS cur, MAX(CASE WHEN idx = n - 1 THEN period END) AS prev
  FROM sper CROSS JOIN (SELECT MAX(idx) AS n FROM sper) m)""",
}

DEPS = {
    "fo": ("o", "oi"), "fact": ("o", "oi", "p", "u", "dc", "fo"), "mcore": ("fact",), "monthly": ("mcore",),
    "months": ("monthly",), "per": ("months",), "ords": ("fact",), "leak": ("ords",),
    "evs": ("ev",), "sess": ("evs",), "sper": ("sess",), "sp": ("sper",),
}


def with_(*names: str, extra: str = "") -> str:
    """WITH clause holding `names` and everything they depend on, in dependency order."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPS.get(n, ()):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [CTE[n] for n in order]
    if extra:
        parts.append(extra.strip())
    return "WITH " + ",\n".join(parts) + "\n"


def r6(expr: str) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 6)"


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


FAMILY = ("o", "oi", "p", "u", "dc", "fo", "fact", "mcore", "monthly", "months", "per", "ords", "leak",
          "seg", "c1", "c2", "contrib", "guard", "drv")


def rename(sql: str, sfx: str, names=FAMILY) -> str:
    """The same CTEs under suffixed names (o -> o_s, ...), so that two data sets (a base and
    an edited copy) can live in one query. Table aliases equal CTE names, so a word-boundary
    rename is consistent."""
    import re
    pat = re.compile(r"\b(" + "|".join(sorted(names, key=len, reverse=True)) + r")\b(?!')")
    return pat.sub(lambda m: m.group(1) + sfx, sql)


def family(*names: str, sfx: str, replace: dict[str, str] | None = None) -> list[str]:
    """CTE texts for `names` (with dependencies) renamed with `sfx`; `replace` swaps the body
    of some CTEs (e.g. the edited orders) before renaming."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPS.get(n, ()):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    replace = replace or {}
    return [rename(replace.get(n, CTE[n]), sfx) for n in order]


# DuckDB sums integers into HUGEINT (and keeps some INTEGER); every integral result is BIGINT.
BIGINT_COLUMNS = {
    "period_totals": ("orders", "items"), "table_manifest": ("checksum",),
    "funnel_two_period": ("sessions_prev", "sessions_cur"),
    "brand_pareto": ("brands_for_50pct", "brands_for_80pct"), "single_sale_brands": ("single_sale_brands",),
    "price_checks": ("sale_price_nonpos", "cost_nonpos", "cost_above_price"),
    "status_consistency": ("violations",), "gap_profile": ("negative",),
    "after_cutoff": ("shipped", "delivered", "returned"), "purchase_rate_by_period": ("non_purchase_sessions",),
    "child_parent_agree": ("mismatches",), "failure_clusters": ("failed_cases",),
    "schema_columns": ("position",), "snapshot_items": ("line_number",),
}


def typed(key: str, sql: str) -> str:
    """The oracle query with its count columns cast to BIGINT."""
    cols = BIGINT_COLUMNS.get(key)
    if not cols:
        return sql
    rep = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) typed_result"
