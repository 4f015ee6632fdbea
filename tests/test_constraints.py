"""The constraint suite, the margin rules and the control: a bad row or a missing plant turns exactly its rule red."""

import pytest
from pyspark.sql import functions as F

from kpilens.operators import constraints as N
from kpilens.operators import margins as M
from kpilens.operators import whatif as J
from kpilens.plans.q_constraints import RULES, all_rules
from kpilens.sources.tables import SCHEMAS, Star
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def raw(spark):
    return Star(spark, SF_SMALL).raw


def red(df):
    return {(r.table_name, r.rule) for r in df.collect() if not r.ok}


def test_suite_covers_every_column(raw):
    names = {(r.table, r.name) for r in all_rules()}
    assert {(t, f"{f.name} is there") for t, s in SCHEMAS.items() for f in s.fields} <= names and len(names) == len(all_rules())


BAD = {("orders", "status letter known"): ("o_orderstatus", "'X'"), ("lineitem", "discount a share"): ("l_discount", "1.5D"),
       ("labels", "toxic 0 or 1"): ("toxic", "2"), ("pages", "url absolute"): ("url", "'ftp://x'"),
       ("part", "p_name is there"): ("p_name", "CAST(NULL AS STRING)"), ("documents", "length as stated"): ("n_chars", "-1L")}


@pytest.mark.parametrize("rule", BAD)
def test_one_bad_row_turns_exactly_its_rule_red(raw, rule):
    table, _ = rule
    column, bad = BAD[rule]
    good = raw[table].limit(50)
    key = good.columns[0] if good.columns[0] != column else good.columns[1]
    one = good.agg(F.min(key)).first()[0]
    first = good.filter(F.col(key) == one).limit(1).withColumn(column, F.expr(bad).cast(good.schema[column].dataType))
    rules = [r for r in all_rules() if r.table == table]
    before = red(N.check({table: good}, rules))
    after = red(N.check({table: good.unionByName(first)}, rules))
    assert after - before == {rule} and not before - after
    broken = N.rows_that_break(first, rules).first()
    assert rule[1] in broken.broken_rules


def test_rules_cost_one_scan(raw):
    plan = N.compile_rules(raw["lineitem"], [r for r in RULES if r.table == "lineitem"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "l_shipdate" not in plan          # and only the columns named


def test_unknown_table_is_an_error(raw):
    with pytest.raises(ValueError, match="planets"):
        N.check(raw, [N.Rule("planets", "x", "true")])


def test_agreement_and_missing_values(spark):
    child = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (3, None, "y"), (9, "z", "z")], "k long, c string, d string")
    parent = spark.createDataFrame([(1, "a", None), (2, "c", "x"), (3, None, None)], "k long, p string, q string")
    got = {r.rule: (r.checked, r.violations, r.ok) for r in N.agreement(child, parent, "k", {
        "plain": ("c", "p", False), "safe": ("c", "p", True), "other": ("d", "q", True)}).collect()}
    assert got == {"plain": (3, 2, False), "safe": (3, 1, False), "other": (3, 1, False)}


def test_ranges(spark):
    one = spark.createDataFrame([(1.9, 5, None)], "a double, b int, c double")
    got = {r.quirk: r.ok for r in N.ranges(one, {"a": (1.8, 2.0), "b": (None, 4), "c": (0, None)}).collect()}
    assert got == {"a": True, "b": False, "c": False}


DRIVER = "scenario string, dimension string, segment string, delta double, share_of_change double, lift double, is_new_segment boolean, driver_rank int"


@pytest.mark.parametrize("change, rule", [({}, None), ({"delta": -5.0}, "direction"), ({"share_of_change": 0.2}, "share"), ({"lift": 1.5}, "lift gap"),
                                          ({"driver_rank": 2}, "rank"), ({"segment": "other"}, "all")])
def test_each_margin_rule(spark, change, rule):
    row = {"scenario": "s", "dimension": "d", "segment": "x", "delta": 5.0, "share_of_change": 0.4, "lift": 3.0, "is_new_segment": False, "driver_rank": 1} | change
    drivers = spark.createDataFrame([tuple(row.values())], DRIVER)
    plants = spark.createDataFrame([("s", "d", "x", 1, 0.3, 1.0, 1)], M.PLANT)
    got = {r.rule for r in M.driver_verdicts(drivers, plants).collect() if not r.ok}
    assert got == ({"present", "direction", "share", "lift gap", "rank"} if rule == "all" else {rule} - {None})


def test_nothing_new_both_ways(spark):
    a = spark.createDataFrame([("d", "x"), ("d", "y")], "dimension string, segment string")
    b = spark.createDataFrame([("d", "y"), ("e", "x")], "dimension string, segment string")
    got = {r.rule: (r.value, r.ok) for r in M.nothing_new(a, b, "c").collect()}
    assert got == {"nothing new": (1.0, False), "nothing gone": (1.0, False)}
    assert all(r.ok for r in M.nothing_new(a, a, "c").collect())


def test_levels_are_loud_exactly_where_planted(spark):
    rows = []
    for m in ("2001-01", "2001-02"):
        for s in "abc":
            back = 60 if (m, s) in {("2001-02", "a"), ("2001-01", "c")} else 10
            rows += [(m, "dc", s, "Returned", back), (m, "dc", s, "Complete", 100 - back)]
    cube = spark.createDataFrame(rows, "month string, dimension string, segment string, order_status string, sale_price int") \
                .withColumn("sale_price", F.col("sale_price").cast("decimal(38,2)"))
    planted = spark.createDataFrame([("a",)], "segment string")
    got = {(r.month, r.segment): (r.loud, r.expected, r.ok) for r in M.level_verdicts(cube, "dc", planted, ["2001-02"]).collect()}
    assert got[("2001-02", "a")] == (True, True, True)
    assert got[("2001-01", "c")] == (True, False, False)                       # a level nobody planted
    assert all(v == (False, False, True) for k, v in got.items() if k not in {("2001-02", "a"), ("2001-01", "c")})


def test_control_sees_a_real_edit(spark):
    """The control's checksums are not constants: an edit that changes one order shows in that table alone."""
    from kpilens.sources.snapshot import table_manifest
    star = Star(spark, SF_SMALL)
    one = star.orders.filter("status = 'Complete'").limit(1).select("order_id")
    edited = J.flip_to_returned(star, one)[0]
    sums = [{r.table_name: r.checksum for r in table_manifest({"orders": s.orders, "order_items": s.order_items}).collect()} for s in (star, edited)]
    assert sums[0]["orders"] != sums[1]["orders"] and sums[0]["order_items"] == sums[1]["order_items"]
