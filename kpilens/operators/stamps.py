"""Lifecycle stamps of orders: shipped, delivered, returned, as one monotone chain.

A missing stamp is the stamp before it plus an offset of up to a few days taken from md5 of the order's key, so it
can never lie before its predecessor and a rerun gives the same time (no random numbers, no state).
The fixtures know when items were shipped; delivery and return times are derived this way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpilens.sources.tables import Star

#: The longest time, in days, from the stamp before.
LONGEST = {"shipped": 3, "delivered": 5, "returned": 3}
DELIVERED = ("Complete", "Returned")


def later(since: Column, key: Column, step: str) -> Column:
    """`since` plus 0 to LONGEST[step] days, whole seconds, by md5 of `step:key`."""
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(step + ":"), key.cast("string"))), 1, 8), 16, 10).cast("long")
    return F.timestamp_add("SECOND", F.pmod(drawn, F.lit(LONGEST[step] * 86_400 + 1)).cast("int"), since)


def order_stamps(star: Star) -> DataFrame:
    """Orders with shipped_at (the first item's ship time), delivered_at of the complete and returned ones and
    returned_at of the returned ones; an order without items has none of them."""
    first_ship = star.order_items.groupBy("order_id").agg(F.min("shipped_at").alias("shipped_at"))
    o = star.orders.join(first_ship, "order_id", "left")
    key = F.col("order_id")
    o = o.withColumn("delivered_at", F.when(F.col("status").isin(*DELIVERED), later(F.col("shipped_at"), key, "delivered")))
    return o.withColumn("returned_at", F.when(F.col("status") == "Returned", later(F.col("delivered_at"), key, "returned")))


def flipped_orders(star: Star, picked: DataFrame) -> DataFrame:
    """All orders with their stamps; the picked ones are Returned, with whatever stamp they lacked filled."""
    ids = picked.select("order_id").distinct().withColumn("edited", F.lit(True))
    o = order_stamps(star).join(ids, "order_id", "left").withColumn("edited", F.coalesce("edited", F.lit(False)))
    key, hit, since = F.col("order_id"), F.col("edited"), F.col("created_at")
    for step in LONGEST:
        name = f"{step}_at"
        o = o.withColumn(name, F.when(hit, F.coalesce(name, later(since, key, step))).otherwise(F.col(name)))
        since = F.col(name)
    return o.withColumn("status", F.when(hit, F.lit("Returned")).otherwise(F.col("status")))


def flipped_items(star: Star, orders: DataFrame) -> DataFrame:
    """All items with the status and the later stamps of their order (an item keeps its own ship time)."""
    o = orders.select("order_id", "status", "delivered_at", "returned_at", "edited")
    return star.order_items.join(o, "order_id", "left")
