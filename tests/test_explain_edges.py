"""Edge frames for the change-explanation rules (FIXTURES.md section 4)."""

from datetime import datetime

import pytest

from kpilens.config import Rules
from kpilens.operators import explain as X
from kpilens.operators import funnel as G
from kpilens.operators import metrics as E
from kpilens.operators.fact import customer_type
from kpilens.plans.kpi import KPI
from tests.frames import FakeStar, fact_rows

RULES = Rules(today="2001-04-01")


def _drivers(spark, rows, measure="revenue"):
    f = fact_rows(spark, rows)
    return X.find_drivers(f, ["2001-01"], ["2001-02"], ("brand",), measure, RULES).collect()


def test_new_segment_is_a_driver_with_infinite_lift(spark):
    rows = [(1, 1, "2001-01", "Complete", 100, "A"), (2, 2, "2001-01", "Complete", 100, "B"),
            (3, 1, "2001-02", "Complete", 100, "A"), (4, 2, "2001-02", "Complete", 100, "B"),
            (5, 3, "2001-02", "Complete", 50, "C")]
    d = _drivers(spark, rows)
    assert [(r.segment, r.is_new_segment, r.lift) for r in d] == [("C", True, None)]
    assert d[0].share_of_change == pytest.approx(1.0)


def test_empty_segment_is_never_a_driver(spark):
    rows = [(1, 1, "2001-01", "Complete", 100, "A"), (2, 2, "2001-01", "Cancelled", 80, "D"),
            (3, 1, "2001-02", "Complete", 150, "A"), (4, 2, "2001-02", "Returned", 90, "D")]
    f = fact_rows(spark, rows)
    c = {r.segment: r for r in X.contribution(f, "brand", ["2001-01"], ["2001-02"], "net_revenue").collect()}
    assert c["D"].prev == 0 and c["D"].cur == 0 and c["D"].lift is None and not c["D"].is_new_segment
    assert "D" not in {r.segment for r in _drivers(spark, rows, "net_revenue")}


def test_small_change_gives_no_drivers(spark):
    rows = [(1, 1, "2001-01", "Complete", 100, "A"), (2, 2, "2001-01", "Complete", 100, "B"),
            (3, 1, "2001-02", "Complete", 50, "A"), (4, 2, "2001-02", "Complete", 152, "B")]
    assert _drivers(spark, rows) == []          # total +1 %: under the 2 % guard


def test_missing_month_is_stepped_over(spark):
    rows = [(1, 1, "2001-01", "Complete", 100, "A"), (2, 1, "2001-03", "Complete", 150, "A")]
    f = fact_rows(spark, rows)
    m = {r.month: r for r in E.monthly_kpis(f, RULES).collect()}
    assert set(m) == {"2001-01", "2001-03"}
    assert m["2001-03"].mom == pytest.approx(0.5)
    assert E.previous_period(sorted(m), ["2001-03"]) == ["2001-01"]


def test_all_lost_month_has_zero_net_revenue(spark):
    rows = [(1, 1, "2001-01", "Cancelled", 100, "A"), (2, 2, "2001-01", "Returned", 50, "A")]
    m = E.monthly_kpis(fact_rows(spark, rows), RULES).collect()[0]
    assert m.net_revenue == 0.0 and m.revenue == 150.0


def _kpi_on(spark, f, today):
    k = KPI(spark, "/nonexistent", Rules(today=today), star=object())
    k.__dict__["fact"] = f
    return k


def test_short_history_raises(spark):
    months = ["2001-01", "2001-02", "2001-03", "2001-04", "2001-05", "2001-06"]
    rows = [(i, 1, m, "Complete", 100 + 10 * i, "A") for i, m in enumerate(months)]
    k = _kpi_on(spark, fact_rows(spark, rows), "2001-07-01")
    with pytest.raises(ValueError, match="history"):
        k.zscore("2001-06")


def test_flat_history_has_zero_sd_and_a_jump_is_unusual(spark):
    months = [f"{2000 + i // 12}-{i % 12 + 1:02d}" for i in range(27)]
    rows = [(i, 1, m, "Complete", 2 ** (i // 1) if i < 26 else 2 ** 25 * 3, "A") for i, m in enumerate(months)]
    f = fact_rows(spark, rows)
    z = {r.month: r for r in X.zscore_table(E.monthly_kpis(f, Rules(today="2003-01-01"))).collect()}
    last = z[months[-1]]
    assert last.hist_sd == 0.0 and last.zscore is None and last.unusual
    assert not z[months[-2]].unusual            # same growth as its history


def test_null_status_is_out_of_the_leakage_denominator(spark):
    rows = [(1, 1, "2001-01", "Cancelled", 10, "A"), (2, 2, "2001-01", "Complete", 10, "A"),
            (3, 3, "2001-01", None, 10, "A")]
    r = G.leakage(fact_rows(spark, rows), "2001-01").collect()[0]
    assert r.cancelled == pytest.approx(0.5) and r.returned == 0.0


def _star(spark, orders, items):
    o = [(oid, uid, "Complete", datetime.fromisoformat(ts), 0.0) for oid, uid, ts in orders]
    it = [(oid, 1, 1, 1, 1, 1.0, "F", datetime(2001, 1, 1), datetime(2001, 1, 1)) for oid in items]
    from decimal import Decimal
    it = [(a, b, c, d, Decimal("1.00"), f, g, h, i) for a, b, c, d, _, f, g, h, i in it]
    return FakeStar(spark, o, it)


def test_tie_on_first_order_makes_both_new(spark):
    s = _star(spark, [(1, 7, "2001-01-01 10:00:00"), (2, 7, "2001-01-01 10:00:00"), (3, 7, "2001-02-01 00:00:00")],
              [1, 2, 3])
    ct = {r.order_id: r.customer_type for r in customer_type(s, "with_items").collect()}
    assert ct == {1: "new", 2: "new", 3: "returning"}


def test_itemless_first_order_depends_on_scope(spark):
    s = _star(spark, [(1, 7, "2001-01-01 10:00:00"), (2, 7, "2001-02-01 10:00:00")], [2])
    with_items = {r.order_id: r.customer_type for r in customer_type(s, "with_items").collect()}
    all_orders = {r.order_id: r.customer_type for r in customer_type(s, "all_orders").collect()}
    assert with_items == {2: "new"}
    assert all_orders == {1: "new", 2: "returning"}


def test_unknown_month_and_dimension_fail_loudly():
    with pytest.raises(ValueError, match="valid: 2001-01 .. 2001-02"):
        E.check_months(["2001-01", "2001-02"], ["2001-03"], "2001-03-01")
    with pytest.raises(ValueError, match="choose from"):
        X.contribution(None, "colour", ["2001-01"], ["2001-02"])


def test_sql_path_takes_dimensions_from_a_closed_map():
    with pytest.raises(ValueError, match="choose from"):
        E.revenue_by_dim_sql(None, "2001-07", ("p.category; DROP TABLE x",))
