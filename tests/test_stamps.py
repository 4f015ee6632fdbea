"""Stamp chains, the edited tables, and the lifecycle checks on hand-made orders."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from kpilens.operators import profile as H
from kpilens.operators import stamps as S
from tests.frames import FakeStar

T0 = datetime(2001, 6, 1, 8)


def star(spark, n=200):
    status = ["Processing", "Shipped", "Complete", "Cancelled", "Returned"]
    orders = [(i, i % 7, status[i % 5], T0 + timedelta(hours=i), 1.0) for i in range(n)]
    items = [(i, k, k, 1, Decimal("5.00"), 1.0, "F", T0, T0 + timedelta(hours=i, days=k)) for i in range(n) if i % 11 for k in (1, 2)]
    return FakeStar(spark, orders, items)


def test_chain_is_monotone_and_bounded(spark):
    o = S.order_stamps(star(spark)).cache()
    bad = (F.col("delivered_at") < F.col("shipped_at")) | (F.col("returned_at") < F.col("delivered_at"))
    late = (F.col("delivered_at") > F.col("shipped_at") + F.expr("INTERVAL '5' DAY"))
    assert o.filter(bad | late).count() == 0
    assert o.filter(F.col("delivered_at").isNotNull()).count() == o.filter("status in ('Complete', 'Returned') and shipped_at is not null").count()
    assert o.select("delivered_at").distinct().count() > 50                  # spread, not one offset


def test_flipped_tables(spark):
    base = star(spark)
    picked = spark.createDataFrame([(i,) for i in range(0, 60, 2)] + [(0,)], "order_id long")     # repeated picks count once
    orders = S.flipped_orders(base, picked)
    rows = {r.order_id: r for r in orders.collect()}
    before = {r.order_id: r for r in S.order_stamps(base).collect()}
    assert len(rows) == 200
    for i, r in rows.items():
        if i < 60 and i % 2 == 0:
            assert r.edited and r.status == "Returned" and r.created_at <= r.shipped_at <= r.delivered_at <= r.returned_at
            for c in ("shipped_at", "delivered_at", "returned_at"):           # what was there stays
                assert before[i][c] is None or before[i][c] == r[c]
        else:
            assert not r.edited and all(r[c] == before[i][c] for c in ("status", "shipped_at", "delivered_at", "returned_at"))
    items = S.flipped_items(base, orders).collect()
    assert len(items) == base.order_items.count()
    assert all(r.status == rows[r.order_id].status and r.returned_at == rows[r.order_id].returned_at for r in items)
    assert [tuple(r) for r in S.flipped_orders(base, picked).orderBy("order_id").collect()] == [tuple(r) for r in orders.orderBy("order_id").collect()]


def test_a_broken_stamp_turns_its_rule_red(spark):
    o = S.order_stamps(star(spark)).filter("shipped_at is not null")
    want = {r.rule: r.violations for r in H.status_consistency(o).collect()}
    some = F.col("order_id") == 4                                            # 4 % 5: Returned
    broken = o.withColumn("returned_at", F.when(~some, F.col("returned_at")))
    got = {r.rule: r.violations for r in H.status_consistency(broken).collect()}
    assert {k for k in got if got[k] != want[k]} == {"returned_but_no_return_time"}
    assert got["returned_but_no_return_time"] == 1 == want["returned_but_no_return_time"] + 1


def test_agreement_treats_two_missing_ship_times_as_equal(spark):
    t = "status string, created_at timestamp_ntz, shipped_at timestamp_ntz"
    orders = spark.createDataFrame([(1, "F", T0, None), (2, "F", T0, T0), (3, None, T0, T0), (4, "O", T0, None)], "order_id long, " + t)
    items = spark.createDataFrame([(1, "F", T0, None), (2, "O", T0 + timedelta(1), None), (3, None, None, T0), (4, "O", T0, T0)], "order_id long, " + t)
    r = H.item_order_agreement(items, orders).first()
    assert (r.pct_status_equal, r.pct_created_equal, r.pct_same_month, r.pct_shipped_equal) == (50.0, 50.0, 75.0, 50.0)


def test_sold_leaves_out_lost_orders(spark):
    orders = [(1, 1, "Complete", T0, 1.0), (2, 1, "Returned", T0, 1.0), (3, 1, None, T0, 1.0)]
    items = [(o, 1, p, 1, Decimal("5.00"), 1.0, "F", T0, T0) for o, p in ((1, 10), (2, 11), (2, 10), (3, 12), (9, 13))]
    s = FakeStar(spark, orders, items)
    s.products = spark.createDataFrame([(p,) for p in range(10, 16)], "id long")
    assert tuple(H.inventory_counts(s).first()) == (6, 2, 4)
