"""The segment cube: exact sums and counts per (month, dimension, segment, order status).

One pass over the fact builds it: every item is expanded to its (dimension, segment) pairs (what GROUPING
SETS does) and to one pair "(all)", and summed map-side. Orders are counted by their first item per (month,
status, order), found within the order's own rows (the fact is joined on the order last, so this needs no
exchange), and only in the "(all)" pair; they stay additive: an order has one month and one status. So no
aggregate has a group per order. Sums are exact (`exact_parts`: whole numbers, as long as the items are many),
reported as DECIMAL, so everything read from the cube equals what the fact gives.

A cube is as long as months x segments x statuses, whatever the fact's size. It is mergeable (`merge`), single
months can be replaced (`replace_months`), and it is stored sorted by month, so period filters skip what they do not need.
Contributions, drivers, leakage and the monthly series are all read from it; the readers return the same
columns as their counterparts over the fact (`explain`, `funnel`, `metrics`), which remain as the second path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpilens.config import DEFAULT_RULES, DIMENSIONS, ORDER_STATUSES, Rules, check_dimension, check_measure
from kpilens.functions.columns import exact_parts, exact_total, fact_months, money, ratio
from kpilens.operators import explain as X
from kpilens.operators.metrics import with_ratios
from kpilens.session import kept

ALL = "(all)"
KEYS = ("month", "dimension", "segment", "order_status")
SUMS = ("sale_price", "net_sale_price", "profit")
COUNTS = ("items", "orders")


def build(fact: DataFrame, dims=DIMENSIONS) -> DataFrame:
    """The cube of a fact; `orders` is filled for the "(all)" pair only."""
    per_order = Window.partitionBy("month", "order_status", "order_id").orderBy("order_id")      # an order's items; groups in turn below
    first = F.col("order_id").isNotNull() & (F.row_number().over(per_order) == 1)
    none = F.lit(0).cast("long")
    parts = {f"{c}_{part}": v for c in SUMS for part, v in zip(("high", "low"), exact_parts(c))}
    items = fact.select("month", "order_status", *dims, *[v.alias(n) for n, v in parts.items()], first.cast("long").alias("first"))
    pairs = [F.struct(F.lit(ALL).alias("dimension"), F.lit(ALL).alias("segment"), F.col("first").alias("orders"))]
    pairs += [F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("segment"), none.alias("orders")) for d in dims]
    rows = items.select("month", "order_status", *parts, F.inline(F.array(*pairs)))
    sums = rows.groupBy(*KEYS).agg(*[F.sum(p).alias(p) for p in parts], F.count(F.lit(1)).alias("items"), F.sum("orders").alias("orders"))
    return sums.select(*KEYS, *[exact_total(f"{c}_high", f"{c}_low").alias(c) for c in SUMS], *COUNTS)


def merge(*cubes: DataFrame) -> DataFrame:
    """The cube of several facts that share no order."""
    both = reduce(DataFrame.unionByName, cubes)
    return both.groupBy(*KEYS).agg(*[F.sum(c).cast("decimal(38,2)").alias(c) for c in SUMS], *[F.sum(c).alias(c) for c in COUNTS])


def replace_months(cube: DataFrame, fact: DataFrame, months: list[str]) -> DataFrame:
    """The cube with some months computed anew; only their rows of the fact are read."""
    return cube.filter(~F.col("month").isin(list(months))).unionByName(build(fact.filter(fact_months(months))))


def store(cube: DataFrame, path: str | None = None) -> DataFrame:
    """Write a cube sorted by month (default: under the cluster's shared checkpoint folder), read it back. Range
    partitions make few files, and month filters skip row groups by their statistics; a folder a month would be
    hundreds of tiny files, each opened by every reader of the whole series."""
    return kept(cube.repartitionByRange("month", "dimension", "segment").sortWithinPartitions("month", "dimension", "segment"),
                "cube", path)


# ---------------------------------------------------------------- readers
def monthly_core(cube: DataFrame) -> DataFrame:
    """E1 over all months."""
    return (cube.filter(F.col("dimension") == ALL).groupBy("month")
                .agg(money(F.sum("sale_price")).alias("revenue"), money(F.sum("net_sale_price")).alias("net_revenue"),
                     F.sum("orders").alias("orders"), F.sum("items").alias("items"), money(F.sum("profit")).alias("profit")))


def monthly_kpis(cube: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """E1-E3 for complete months."""
    return with_ratios(monthly_core(cube).filter(F.col("month") < F.lit(rules.today_month)))


def segment_periods(cube: DataFrame, prev: list[str], cur: list[str], dims=DIMENSIONS, measure: str | tuple = "revenue") -> DataFrame:
    """(dimension, segment, measure, prev, cur): both periods' sums of every segment."""
    measures = (measure,) if isinstance(measure, str) else tuple(measure)
    for d in dims:
        check_dimension(d)
    zero = F.lit(0).cast("decimal(38,2)")

    def over(months: list[str], column: str) -> Column:
        return F.sum(F.when(F.col("month").isin(*months), F.col(column)).otherwise(zero)).cast("decimal(38,2)")
    rows = cube.filter(F.col("month").isin(*prev, *cur) & F.col("dimension").isin(*dims))
    agg = rows.groupBy("dimension", "segment").agg(*[over(p, check_measure(m)).alias(f"{n}_{m}") for m in measures
                                                     for n, p in (("p", prev), ("c", cur))])
    return agg.select("dimension", "segment", F.inline(F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(f"p_{m}").alias("prev"), F.col(f"c_{m}").alias("cur")) for m in measures])))


def contribution(cube: DataFrame, dim: str, prev: list[str], cur: list[str], measure: str = "revenue") -> DataFrame:
    """F5 / F6."""
    return X.contribution_from(segment_periods(cube, prev, cur, (dim,), measure))


def contribution_all(cube: DataFrame, prev: list[str], cur: list[str], measure: str = "revenue", dims=DIMENSIONS) -> DataFrame:
    """F10."""
    return X.contribution_from(segment_periods(cube, prev, cur, dims, measure))


def find_drivers(cube: DataFrame, prev: list[str], cur: list[str], dims=DIMENSIONS, measure: str | tuple = "revenue",
                 rules: Rules = DEFAULT_RULES) -> DataFrame:
    """F8 / F9."""
    seg = segment_periods(cube, prev, cur, dims, measure)
    return X.drivers_from(X.contribution_from(seg), X.guard_from_segments(seg, dims[0], rules), rules)


def _orders(status: str | None = None) -> Column:
    """Orders of one status, or of any that is not NULL."""
    hit = F.col("order_status").isNotNull() if status is None else F.col("order_status") == status
    return F.sum(F.when(hit, F.col("orders")).otherwise(0))


def _status_shares(cube: DataFrame, names: dict[str, str]) -> list[Column]:
    return [ratio(_orders(s), _orders()).alias(n) for s, n in names.items()]


LEAKS = {"Cancelled": "cancelled", "Returned": "returned"}


def leakage(cube: DataFrame, month: str) -> DataFrame:
    """G5."""
    rows = cube.filter((F.col("dimension") == ALL) & (F.col("month") == month))
    return rows.agg(*_status_shares(rows, LEAKS))


def leakage_by_month(cube: DataFrame, months_before: str | None = None) -> DataFrame:
    """G5 for every month whose orders have a status."""
    rows = cube.filter((F.col("dimension") == ALL) & F.col("order_status").isNotNull())
    if months_before:
        rows = rows.filter(F.col("month") < months_before)
    return rows.groupBy("month").agg(*_status_shares(rows, LEAKS))


def status_share_by_month(cube: DataFrame, months_before: str | None = None) -> DataFrame:
    """G7."""
    rows = cube.filter(F.col("dimension") == ALL)
    if months_before:
        rows = rows.filter(F.col("month") < months_before)
    return rows.groupBy("month").agg(*_status_shares(rows, {s: s.lower() for s in ORDER_STATUSES}))


def leakage_by_dim(cube: DataFrame, month: str | list[str], by: str) -> DataFrame:
    """G6."""
    check_dimension(by, DIMENSIONS)
    months = [month] if isinstance(month, str) else list(month)
    rows = cube.filter((F.col("dimension") == by) & F.col("month").isin(*months))
    zero = F.lit(0).cast("decimal(38,2)")

    def lost(status: str) -> Column:
        return F.sum(F.when(F.col("order_status") == status, F.col("sale_price")).otherwise(zero))
    g = rows.groupBy("segment").agg(F.sum("sale_price").alias("rev"), lost("Cancelled").alias("c"), lost("Returned").alias("r"))
    return g.select("segment", money("rev").alias("revenue"), ratio("c", "rev").alias("cancelled"), ratio("r", "rev").alias("returned"))


def item_return_rate(cube: DataFrame, months: list[str], by: str = "dist_center") -> DataFrame:
    """G8."""
    check_dimension(by, DIMENSIONS)
    rows = cube.filter((F.col("dimension") == by) & F.col("month").isin(*months))
    known = F.sum(F.when(F.col("order_status").isNotNull(), F.col("items")).otherwise(0))
    returned = F.sum(F.when(F.col("order_status") == "Returned", F.col("items")).otherwise(0))
    return rows.groupBy("segment").agg(F.sum("items").alias("items"), (100 * ratio(returned, known)).alias("returned_pct"))


def segment_revenue(cube: DataFrame, months: list[str], dims=DIMENSIONS) -> DataFrame:
    """(month, dimension, segment, revenue) of some months, as exact sums."""
    rows = cube.filter(F.col("month").isin(*months) & F.col("dimension").isin(*dims))
    return rows.groupBy("month", "dimension", "segment").agg(F.sum("sale_price").alias("revenue"))
