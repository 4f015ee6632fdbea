"""The distributed re-formulations against brute force on small random inputs
(including a hot key holding a third of the rows)."""

import hashlib
import random
import statistics
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from kpilens.functions.quantiles import exact_quantiles
from tests.conftest import SF_SMALL
from kpilens.operators.explain import leave_one_out_median
from kpilens.operators.sessions import split_by_gap
from kpilens.operators.whatif import nearest_session, nearest_session_1to1, sample_exact


def test_exact_quantiles_match_numpy_linear(spark):
    rng = random.Random(1)
    vals = [round(rng.uniform(-50, 500), 2) for _ in range(3000)] + [7.0] * 1500       # hot value
    grp = [i % 3 for i in range(len(vals))]
    df = spark.createDataFrame(list(zip(grp, vals)), "g int, v double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0]
    got = {(r.g, r.p): r.q for r in exact_quantiles(df, "v", probs, by=["g"]).collect()}
    for g in range(3):
        arr = np.array([v for gg, v in zip(grp, vals) if gg == g])
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(np.quantile(arr, p)), rel=1e-12, abs=1e-9)


def test_sample_exact_takes_round_half_even_smallest_hashes(spark):
    ids = list(range(1, 251)) + list(range(1000, 1003))
    grp = ["a" if i < 200 else "b" for i in ids]
    df = spark.createDataFrame(list(zip(ids, grp)), "order_id long, month string")
    got = sample_exact(df, "order_id", 0.8, by=["month"]).collect()
    for g in ("a", "b"):
        members = [i for i, gg in zip(ids, grp) if gg == g]
        k = round(0.8 * len(members))
        h = sorted(members, key=lambda i: (int(hashlib.md5(str(i).encode()).hexdigest()[:13], 16), i))[:k]
        assert sorted(r.order_id for r in got if r.month == g) == sorted(h)


def _sessions_brute(rows, gap):
    out = {}
    for u in {r[1] for r in rows}:
        ev = sorted((r for r in rows if r[1] == u), key=lambda r: (r[2], r[0]))
        n, prev = 0, None
        for r in ev:
            if prev is None or (r[2] - prev).total_seconds() > gap:
                n += 1
            out[r[0]] = n
            prev = r[2]
    return out


def test_split_by_gap_matches_a_sequential_scan(spark):
    rng = random.Random(7)
    base = datetime(2024, 1, 1)
    rows = []
    for i in range(4000):
        u = 0 if i % 3 == 0 else rng.randint(1, 40)                        # user 0 holds a third
        rows.append((i, u, base + timedelta(seconds=rng.randint(0, 20 * 86400))))
    rows.append((99999, 5, rows[10][2]))                                    # exact tie on time
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    got = {r.event_id: r.session_no for r in split_by_gap(df, "user_id", "ts", "event_id", 6 * 3600).collect()}
    assert got == _sessions_brute(rows, 6 * 3600)


def _greedy_brute(items, sessions, before=3, after=1):
    out, used = {}, set()
    for it in sorted(items, key=lambda r: (r[2], r[0])):
        c = [s for s in sessions if s[1] == it[1] and s[0] not in used
             and -before * 86400 <= (s[2] - it[2]).total_seconds() <= after * 86400]
        if c:
            best = min(c, key=lambda s: (abs((s[2] - it[2]).total_seconds()), s[2], s[0]))
            used.add(best[0])
            out[it[0]] = best[0]
    return out


def test_nearest_session_one_to_one_matches_greedy(spark):
    rng = random.Random(3)
    base = datetime(2024, 1, 1)
    items = [(i, rng.randint(1, 6), base + timedelta(hours=rng.randint(0, 24 * 30))) for i in range(300)]
    sess = [(f"s{i}", rng.randint(1, 6), base + timedelta(hours=rng.randint(0, 24 * 30))) for i in range(200)]
    it = spark.createDataFrame(items, "item_id long, user_id long, ts timestamp_ntz")
    ss = spark.createDataFrame(sess, "session_id string, user_id long, started_at timestamp_ntz")
    got = {r.item_id: r.session_id for r in nearest_session_1to1(it, ss).collect()}
    assert got == _greedy_brute(items, sess)
    plain = {r.item_id: r.session_id for r in nearest_session(it, ss).collect()}
    for i in items:
        c = [s for s in sess if s[1] == i[1] and -3 * 86400 <= (s[2] - i[2]).total_seconds() <= 86400]
        if c:
            assert plain[i[0]] == min(c, key=lambda s: (abs((s[2] - i[2]).total_seconds()), s[2], s[0]))[0]
        else:
            assert i[0] not in plain


def test_leave_one_out_median(spark):
    vals = {"a": 0.1, "b": 0.4, "c": 0.15, "d": 0.12, "e": 0.5}
    df = spark.createDataFrame(list(vals.items()), "segment string, returned double")
    got = {r.segment: r.others_median for r in leave_one_out_median(df, "returned").collect()}
    for s, _ in vals.items():
        assert got[s] == pytest.approx(statistics.median([v for k, v in vals.items() if k != s]))



def test_exact_quantiles_refine_over_levels(spark):
    rng = random.Random(5)
    vals = [rng.gauss(0, 1) for _ in range(20000)] + [1e15, -1e15] + [0.25] * 5000     # outliers and a hot value
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.01, 0.3, 0.5, 0.77, 0.999]
    got = {r.p: r.q for r in exact_quantiles(df, "v", probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(np.array(vals), p)), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 10])
def test_leave_one_out_median_sizes(spark, n):
    rng = random.Random(n)
    vals = {f"s{i}": round(rng.uniform(0, 1), 3) for i in range(n)}
    vals["dup"] = next(iter(vals.values()))                                  # a tie
    df = spark.createDataFrame(list(vals.items()), "segment string, returned double")
    got = {r.segment: r.others_median for r in leave_one_out_median(df, "returned").collect()}
    for s in vals:
        others = [v for k, v in vals.items() if k != s]
        want = statistics.median(others) if others else None
        assert (got[s] is None and want is None) or got[s] == pytest.approx(want)


def test_nearest_session_one_to_one_with_sparse_sessions_and_a_hot_user(spark):
    rng = random.Random(11)
    base = datetime(2024, 1, 1)
    items = [(i, 0 if i % 3 == 0 else rng.randint(1, 9), base + timedelta(minutes=rng.randint(0, 60 * 24 * 90)))
             for i in range(600)]
    sess = [(f"s{i}", 0 if i % 2 == 0 else rng.randint(1, 9), base + timedelta(minutes=rng.randint(0, 60 * 24 * 90)))
            for i in range(120)]
    it = spark.createDataFrame(items, "item_id long, user_id long, ts timestamp_ntz")
    ss = spark.createDataFrame(sess, "session_id string, user_id long, started_at timestamp_ntz")
    got = {r.item_id: r.session_id for r in nearest_session_1to1(it, ss).collect()}
    assert got == _greedy_brute(items, sess)


def test_drop_orders_cascades_to_matched_sessions(spark):
    from decimal import Decimal

    from kpilens.operators.whatif import drop_orders
    from tests.frames import FakeStar
    t0 = datetime(2024, 1, 10, 12)
    orders = [(1, 7, "Complete", t0, 0.0), (2, 7, "Complete", t0, 0.0), (3, 8, "Complete", t0, 0.0)]
    items = [(1, 1, 5, 1, Decimal("9.99"), 1.0, "F", t0, t0), (1, 2, 6, 1, Decimal("5.00"), 1.0, "F", t0, t0),
             (3, 1, 5, 1, Decimal("9.99"), 1.0, "F", t0, t0)]
    star = FakeStar(spark, orders, items)
    sess = spark.createDataFrame([("a", 7, t0 - timedelta(hours=1)), ("b", 7, t0 - timedelta(days=2)),
                                  ("c", 7, t0 - timedelta(days=5)), ("d", 8, t0)],
                                 "session_id string, user_id long, started_at timestamp_ntz")
    picked = spark.createDataFrame([(1,)], "order_id long")
    it = (star.order_items.join(star.orders.select("order_id", "user_id"), "order_id").join(picked, "order_id")
          .select((F.col("order_id") * 10 + F.col("line_number")).alias("item_id"), "user_id",
                  F.col("created_at").alias("ts")))
    matches = nearest_session_1to1(it, sess)
    edited, report, remaining = drop_orders(star, picked, sess, matches)
    assert sorted(r.session_id for r in matches.collect()) == ["a", "b"]       # c is 5 days before: out of range
    assert sorted(r.session_id for r in remaining.collect()) == ["c", "d"]
    r = report.collect()[0]
    assert (r.orders_before, r.orders_after, r.items_before, r.items_after) == (3, 2, 3, 1)
    assert (r.revenue_removed, r.sessions_removed) == (14.99, 2)


def test_one_to_one_match_streams_a_hot_user(spark):
    """One user whose items all share sessions: no pair table, only the sessions in reach are held."""
    from kpilens.operators import whatif as J
    rng, base = random.Random(12), datetime(2024, 1, 1)
    items = [(i, 1, base + timedelta(minutes=rng.randrange(60 * 24 * 40))) for i in range(4000)]
    sess = [(f"s{i}", 1, base + timedelta(minutes=rng.randrange(60 * 24 * 40))) for i in range(3000)]
    held = []

    lines = sorted([((t - timedelta(days=1) - base).total_seconds() * 1e6, 0, f"{i:05}", s) for i, (s, _, t) in enumerate(sess)]
                   + [((t - base).total_seconds() * 1e6, 1, f"{i:05}", None) for i, _, t in items])
    import pandas as pd
    frame = pd.DataFrame([(1, 1, int(at), None if kind == 0 else name, s) for at, kind, name, s in lines],
                         columns=["user_id", "run", "at_us", "item_id", "session_id"])
    old, J.insort = J.insort, lambda a, x: (old(a, x), held.append(len(a)))[0]
    try:
        day = J.DAY * 1_000_000
        out = pd.concat(J._match_in_order((frame[k:k + 500] for k in range(0, len(frame), 500)), 3 * day, day))
    finally:
        J.insort = old
    assert max(held) < 500                                 # 4 of 40 days of the 3,000 sessions, not all of them
    it = spark.createDataFrame(items, "item_id long, user_id long, ts timestamp_ntz")
    ss = spark.createDataFrame(sess, "session_id string, user_id long, started_at timestamp_ntz")
    got = {r.item_id: r.session_id for r in nearest_session_1to1(it, ss).collect()}
    assert got == _greedy_brute(items, sess)
    assert {int(a): b for a, b in zip(out["item_id"], out["session_id"])} == got


def test_gaps_do_not_depend_on_the_session_time_zone(spark):
    base = datetime(2024, 3, 9, 22)                       # a DST change follows in America/New_York
    rows = [(i, 1, base + timedelta(hours=5.5 * i)) for i in range(4)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = {r.event_id: r.session_no for r in split_by_gap(df, "user_id", "ts", "event_id", 6 * 3600).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == _sessions_brute(rows, 6 * 3600)         # 5.5 h apart on the wall clock: one session


def test_surge_multipliers_and_sample_rates(spark):
    from kpilens.operators import whatif as J
    from kpilens.sources.tables import Star
    star = Star(spark, SF_SMALL, "2001-08-01")
    pool = J.orders_of_source(star, "2001-07", "BUILDING")
    n = pool.count()
    with pytest.raises(ValueError, match="1 or more"):
        J.surge(star, "2001-07", "BUILDING", 0.5)
    edited, none = J.surge(star, "2001-07", "BUILDING", 1.0)
    assert none.count() == 0 and edited.orders.count() == star.orders.count() and J.planted_delta(star, none).count() == 0
    edited, new = J.surge(star, "2001-07", "BUILDING", 2.5)
    assert none.columns == new.columns and new.count() == n + round(n / 2)
    ids = edited.orders.select("order_id")
    assert ids.distinct().count() == ids.count() == star.orders.count() + n + round(n / 2)
    with pytest.raises(ValueError, match="between 0 and 1"):
        J.sample_exact(pool, "order_id", 1.5)


def test_drop_report_is_one_pass_a_table(spark):
    from decimal import Decimal

    from kpilens.operators.whatif import drop_orders
    from tests.frames import FakeStar
    t0 = datetime(2024, 1, 10, 12)
    orders = [(o, 7, "Complete", t0, 0.0) for o in (1, 1, 2, None)]
    items = [(o, 1, 5, 1, p, 1.0, "F", t0, t0) for o, p in [(1, Decimal("9.99"))] * 2 + [(1, None), (2, Decimal(5)), (None, Decimal(7))]]
    report = drop_orders(FakeStar(spark, orders, items), spark.createDataFrame([(1,), (1,), (None,)], "order_id long"))[1]
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan and "LeftSemi" not in plan
    assert tuple(report.first()) == (4, 2, 5, 2, 19.98)
    none = drop_orders(FakeStar(spark, orders, items), spark.createDataFrame([], "order_id long"))[1]
    assert tuple(none.first()) == (4, 4, 5, 5, 0.0)
