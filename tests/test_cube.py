"""The segment cube against the same questions asked of the fact."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from kpilens.config import DIMENSIONS
from kpilens.operators import cube as C
from kpilens.operators import explain as X
from kpilens.operators import funnel as G
from kpilens.operators import metrics as E
from kpilens.plans.registry import finish

MONTHS = ["2001-01", "2001-02", "2001-03", "2001-04"]


@pytest.fixture(scope="module")
def fact(spark):
    rng, rows = random.Random(9), []
    for order in range(400):
        month, status = rng.choice(MONTHS), rng.choice(["Complete", "Cancelled", "Returned", "Shipped", None])
        dims = {"customer_type": rng.choice(["new", "returning"]), "acq_source": rng.choice("ab"), "country": rng.choice("xyz")}
        for _ in range(rng.choice([1, 1, 2, 5])):
            price = Decimal(rng.randrange(1, 90000)) / 100
            net = Decimal(0) if status in ("Cancelled", "Returned") else price
            rows.append((order, month, status, price, net, price - 3, dims["customer_type"], dims["acq_source"], dims["country"],
                         rng.choice(["m", "f"]), rng.choice("klmn"), rng.choice("pqrstu"), rng.choice(["c1", "c2", "c3"])))
    df = spark.createDataFrame(rows, "order_id long, month string, order_status string, sale_price decimal(18,2), net_sale_price decimal(18,2), "
                                     "profit decimal(18,2), " + ", ".join(f"{d} string" for d in DIMENSIONS))
    return df.withColumn("order_created_at", F.concat("month", F.lit("-15 10:00:00")).cast("timestamp_ntz")).cache()


@pytest.fixture(scope="module")
def cube(fact):
    return C.store(C.build(fact))


def rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r) for r in finish(df).select(*cols).collect()), key=repr)


def test_readers_equal_the_fact(fact, cube):
    prev, cur = MONTHS[:2], MONTHS[2:]
    both = ("revenue", "net_revenue")
    for got, want in [
            (C.monthly_core(cube), E.monthly_core(fact)),
            (C.monthly_kpis(cube), E.monthly_kpis(fact)),
            (C.contribution_all(cube, prev, cur), X.contribution_all(fact, prev, cur)),
            (C.contribution(cube, "brand", prev[:1], cur[:1], "net_revenue"), X.contribution(fact, "brand", prev[:1], cur[:1], "net_revenue")),
            (C.find_drivers(cube, prev, cur, DIMENSIONS, both), X.find_drivers(fact, prev, cur, DIMENSIONS, both)),
            (C.leakage(cube, "2001-02"), G.leakage(fact, "2001-02")),
            (C.leakage_by_month(cube, "2001-04"), G.leakage_by_month(fact, "2001-04")),
            (C.status_share_by_month(cube), G.status_share_by_month(fact)),
            (C.leakage_by_dim(cube, "2001-03", "dist_center"), G.leakage_by_dim(fact, "2001-03", "dist_center")),
            (C.leakage_by_dim(cube, cur, "country"), G.leakage_by_dim(fact, cur, "country")),
            (C.item_return_rate(cube, prev), G.item_return_rate(fact, prev))]:
        assert rows(got) == rows(want)


def test_merge_and_replaced_months(fact, cube):
    even = F.col("order_id") % 2 == 0
    assert rows(C.merge(C.build(fact.filter(even)), C.build(fact.filter(~even)))) == rows(cube)
    stale = C.build(fact.filter((F.col("month") != "2001-03") | even))
    assert rows(stale) != rows(cube)
    assert rows(C.replace_months(stale, fact, ["2001-03"])) == rows(cube)


def test_month_filters_reach_the_scan(cube):
    plan = C.leakage_by_dim(cube, "2001-03", "dist_center")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(month,2001-03)" in plan and "EqualTo(dimension,dist_center)" in plan


def test_empty_fact(fact):
    none = C.store(C.build(fact.limit(0)))
    assert none.count() == 0 and C.monthly_core(none).count() == 0


def test_unknown_dimension(cube):
    with pytest.raises(ValueError, match="dimension"):
        C.leakage_by_dim(cube, "2001-03", "planet")


def test_no_group_per_order_and_exact_sums_of_large_amounts(spark, fact):
    assert "order_key" not in C.build(fact)._jdf.queryExecution().optimizedPlan().toString()
    most = Decimal("9999999999999999.99")
    few = fact.limit(1).drop("order_id", "sale_price", "net_sale_price", "profit")
    money = [F.lit(most).cast("decimal(18,2)").alias("sale_price"), F.lit(-most).cast("decimal(18,2)").alias("net_sale_price"),
             (F.lit(most).cast("decimal(18,2)") - F.lit(-most).cast("decimal(18,2)")).alias("profit")]
    many = few.crossJoin(spark.range(1000).select(F.nullif(F.col("id") % 10, F.lit(0)).alias("order_id"))).select("*", *money)
    r = C.build(many).filter(F.col("dimension") == C.ALL).first()
    assert (r.sale_price, r.net_sale_price, r.profit) == (1000 * most, -1000 * most, 2000 * most)
    assert (r.items, r.orders) == (1000, 9)                                            # a null order is none


def test_months_in_scope(spark):
    from datetime import datetime

    from tests.frames import FakeStar
    at = [datetime(2001, m, 5) for m in range(1, 9)]
    orders = [(1, 1, "Complete", at[0], 0.0), (2, 1, "Complete", at[1], 0.0), (3, 1, "Complete", at[2], 0.0),
              (4, 1, "Complete", at[2], 0.0), (5, 1, "Complete", at[2], 0.0), (None, 1, "Complete", at[3], 0.0), (9, 1, "Complete", at[7], 0.0)]
    items = [(o, 1, 5, 1, Decimal("9.99"), 1.0, "F", at[0], at[0]) for o in (1, 4, None, 9)]
    star = FakeStar(spark, orders, items)
    assert E.months_in_scope(star) == ["2001-01", "2001-03"]         # 03 by its middle order only; 02 and 04 without items; 08 is open
