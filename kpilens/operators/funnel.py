"""Session funnel and order leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpilens.config import DIMENSIONS, ORDER_STATUSES, SESSION_DIMENSIONS, UNKNOWN, check_dimension
from kpilens.functions.columns import fact_months, money, ratio


def _rate(c: str):
    return F.avg(F.col(c).cast("int"))


def funnel(sessions: DataFrame, period: str, by: str | None = None) -> DataFrame:
    """G1 / G2 (R15): sessions, cart rate and purchase rate of ONE period, overall
    (segment 'all') or per session dimension; a NULL segment is '(unknown)' (R17)."""
    if by is not None:
        check_dimension(by, SESSION_DIMENSIONS)
    s = sessions.filter(F.col("period") == period)
    key = F.coalesce(F.col(by), F.lit(UNKNOWN)) if by else F.lit("all")
    return (s.groupBy(key.alias("segment"))
             .agg(F.count(F.lit(1)).alias("sessions"), _rate("added_to_cart").alias("cart_rate"),
                  _rate("purchased").alias("purchase_rate")))


def funnel_by_period(sessions: DataFrame, last: int | None = 4) -> DataFrame:
    """Sessions and the three rates per period (the last `last` periods)."""
    g = (sessions.groupBy("period")
                 .agg(F.count(F.lit(1)).alias("sessions"), _rate("saw_product").alias("saw_product"),
                      _rate("added_to_cart").alias("added_to_cart"), _rate("purchased").alias("purchased")))
    return g.orderBy(F.desc("period")).limit(last) if last else g


def funnel_two_period(sessions: DataFrame, prev: str, cur: str, by: tuple[str, ...] = SESSION_DIMENSIONS) -> DataFrame:
    """Per session dimension and segment, sessions and conversion in both periods side by side.
    All dimensions in one pass: a session is expanded to its (dimension, segment) pairs."""
    for d in by:
        check_dimension(d, SESSION_DIMENSIONS)
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d), F.lit(UNKNOWN)).alias("segment")) for d in by])
    s = sessions.filter(F.col("period").isin(prev, cur)).select("period", "purchased", F.inline(pairs))
    is_p, is_c = F.col("period") == prev, F.col("period") == cur
    g = s.groupBy("dimension", "segment").agg(
        F.sum(is_p.cast("long")).alias("sessions_prev"), F.sum(is_c.cast("long")).alias("sessions_cur"),
        F.avg(F.when(is_p, F.col("purchased").cast("int"))).alias("conv_prev"),
        F.avg(F.when(is_c, F.col("purchased").cast("int"))).alias("conv_cur"))
    return g.withColumn("sessions_chg_pct",
                        F.when(F.col("sessions_prev") != 0,
                               100 * (F.col("sessions_cur") / F.col("sessions_prev") - 1)))


def order_rows(fact: DataFrame) -> DataFrame:
    """One row per order of the fact (orders with items): month and status."""
    return fact.select("order_id", "month", "order_status").distinct()


def leakage(fact: DataFrame, month: str) -> DataFrame:
    """G5 (R21): share of ORDERS cancelled / returned; NULL status is out of the denominator."""
    o = order_rows(fact.filter(fact_months(month))).filter(F.col("order_status").isNotNull())
    return o.agg(F.avg((F.col("order_status") == "Cancelled").cast("int")).alias("cancelled"),
                 F.avg((F.col("order_status") == "Returned").cast("int")).alias("returned"))


def leakage_by_month(fact: DataFrame, months_before: str | None = None) -> DataFrame:
    """G5 for every month (optionally only months < months_before) in one aggregate."""
    o = order_rows(fact).filter(F.col("order_status").isNotNull())
    if months_before:
        o = o.filter(F.col("month") < months_before)
    return (o.groupBy("month")
             .agg(F.avg((F.col("order_status") == "Cancelled").cast("int")).alias("cancelled"),
                  F.avg((F.col("order_status") == "Returned").cast("int")).alias("returned")))


def status_share_by_month(fact: DataFrame, months_before: str | None = None) -> DataFrame:
    """Order share of every status per month (fixed status vocabulary)."""
    o = order_rows(fact)
    if months_before:
        o = o.filter(F.col("month") < months_before)
    return o.groupBy("month").agg(
        *[F.avg((F.col("order_status") == s).cast("int")).alias(s.lower()) for s in ORDER_STATUSES])


def leakage_by_dim(fact: DataFrame, month: str | list[str], by: str) -> DataFrame:
    """G6 (R21): per segment, revenue and the share of REVENUE in cancelled / returned orders."""
    check_dimension(by, DIMENSIONS)
    f = fact.filter(fact_months(month))
    zero = F.lit(0).cast("decimal(18,2)")
    g = f.groupBy(F.col(by).alias("segment")).agg(
        F.sum("sale_price").alias("rev"),
        F.sum(F.when(F.col("order_status") == "Cancelled", F.col("sale_price")).otherwise(zero)).alias("c"),
        F.sum(F.when(F.col("order_status") == "Returned", F.col("sale_price")).otherwise(zero)).alias("r"))
    return g.select("segment", money("rev").alias("revenue"), ratio("c", "rev").alias("cancelled"),
                    ratio("r", "rev").alias("returned"))


def item_return_rate(fact: DataFrame, months: list[str], by: str = "dist_center") -> DataFrame:
    """Items and % of ITEMS in returned orders per segment, months pooled."""
    f = fact.filter(fact_months(months))
    return f.groupBy(F.col(by).alias("segment")).agg(
        F.count(F.lit(1)).alias("items"),
        (100 * F.avg((F.col("order_status") == "Returned").cast("int"))).alias("returned_pct"))
