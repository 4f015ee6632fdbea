"""The item-grain fact and its derived columns.

Plan shape (one shuffle per non-broadcast join, no fact-sized window):
  orders --semi(items.order_id)--> orders with items --groupBy(user_id).min--> first order (C4)
  orders ⋈ first order ⋈ users  (all keyed by user_id: one exchange of orders)
  items ⋈ products (product_id)  ⋈ centres (supplier_id)  ⋈ that (order_id)
The orders come last: the items travel without the orders' columns, and the rows of an order end
up side by side, so whoever counts orders needs no further exchange.
C4 is an aggregate + join rather than `min().over(partitionBy(user_id))`: the
aggregate combines map-side, and AQE can split a hot user in the join, while a
window would put every row of a hot user into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpilens.config import DEFAULT_RULES, LOST_STATUSES, UNKNOWN, Rules
from kpilens.sources.tables import Star, month_key

UNKNOWN_FILLED = ("category", "brand", "department", "dist_center", "acq_source", "country")


def orders_in_scope(star: Star, scope: str = "with_items") -> DataFrame:
    """R5 scope: orders with at least one item (default), or every order (SQL twin)."""
    o = star.orders
    if scope == "all_orders":
        return o
    if scope != "with_items":
        raise ValueError(f"unknown scope {scope!r}; available: with_items, all_orders")
    # distinct first: the partial aggregate dedupes an order's items map-side, so the
    # semi join shuffles one key per order and partition instead of one per item
    return o.join(star.order_items.select("order_id").distinct(), "order_id", "left_semi")


def first_orders(star: Star, scope: str = "with_items") -> DataFrame:
    """Per user, the time of the first order ever (second precision, R13)."""
    return (orders_in_scope(star, scope)
            .groupBy("user_id")
            .agg(F.min(F.date_trunc("second", "created_at")).alias("first_at")))


def customer_type(star: Star, scope: str = "with_items") -> DataFrame:
    """C4 at order grain: `new` iff the order's time equals the user's first order time;
    ties at the same second are all `new`."""
    return _typed(orders_in_scope(star, scope), first_orders(star, scope)).drop("status")


def _typed(orders: DataFrame, first: DataFrame) -> DataFrame:
    return (orders.join(first, "user_id", "left")
                  .select("order_id", "user_id", "created_at", "status",
                          F.when(F.date_trunc("second", "created_at") == F.col("first_at"), "new")
                           .otherwise("returning").alias("customer_type")))


def build_fact(star: Star, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per item sold (rows are never de-duplicated), every dimension attached."""
    users = star.users.select(F.col("id").alias("user_id"), F.col("traffic_source").alias("acq_source"),
                              "country")
    # the inner join with the items below keeps orders with items, so only the first-order
    # aggregate needs the semi join
    orders = _typed(star.orders, first_orders(star, rules.scope)).join(users, "user_id")
    orders = orders.withColumn("month", month_key("created_at"))         # once per order, not per item
    items = star.order_items.select("order_id", "product_id", "supplier_id", "sale_price",
                                    F.col("created_at").alias("item_created_at"))
    products = star.products.select(F.col("id").alias("product_id"), "cost", "category", "brand",
                                    "department")
    centres = star.distribution_centers.select(F.col("id").alias("supplier_id"),
                                               F.col("name").alias("dist_center"))
    f = (items.join(products, "product_id")
              .join(centres, "supplier_id")
              .join(orders, "order_id"))
    lost = F.coalesce(F.col("order_status").isin(*LOST_STATUSES), F.lit(False))
    return (f.select(
        "order_id", "user_id", "sale_price",
        "month",
        F.col("created_at").alias("order_created_at"),
        F.col("status").alias("order_status"),
        "cost",
        *[F.coalesce(F.col(d), F.lit(UNKNOWN)).alias(d) for d in
          ("category", "brand", "department", "dist_center", "acq_source", "country")],
        "customer_type",
        (F.col("sale_price") - F.col("cost")).alias("profit"),
        lost.alias("lost"),
        F.when(lost, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("sale_price")).alias("net_sale_price"),
        "item_created_at",
    ))

