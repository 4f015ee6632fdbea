"""The streaming sessioniser replays the events table and agrees with the batch one
on every session it has closed."""

import os
import random
import tempfile
from datetime import datetime, timedelta

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from kpilens.operators.sessions import sessions_from_events
from kpilens.sources.tables import SCHEMAS, read_table
from kpilens.streaming.exact_sessions import _intervals, merge_intervals, sessionize_exact
from kpilens.streaming.sessions import read_events_stream, sessionize_stream, start_sessions_sink
from tests.conftest import SF_SMALL


def test_stream_replay_matches_batch(spark):
    out = tempfile.mkdtemp(prefix="kpilens-stream-")
    q = start_sessions_sink(sessionize_stream(read_events_stream(spark, f"{SF_SMALL}/events.parquet")), out)
    q.awaitTermination(300)
    streamed = spark.read.parquet(out)
    batch = sessions_from_events(read_table(spark, SF_SMALL, "events"))
    key = ["user_id", "started_at", "n_events", "traffic_source", "browser", "purchased", "added_to_cart"]
    s = {tuple(r) for r in streamed.select(*key).collect()}
    b = {tuple(r) for r in batch.select(*key).collect()}
    assert len(s) > 0.5 * len(b)            # all but the sessions still open at the watermark
    assert s <= b
    closed = batch.agg(F.max("started_at")).collect()[0][0]
    assert closed is not None


DIMS = ["user_id", "traffic_source", "browser", "started_at", "n_events", "saw_product", "added_to_cart", "purchased", "period"]


def _run_exact(spark, tmp_path, batches, watermark="1 day"):
    """Closed sessions after each list of rows came as one micro-batch."""
    src, out = tmp_path / "in", str(tmp_path / "out")
    schema = SCHEMAS["events"]
    for i, rows in enumerate(batches):
        path = src / f"b{i}.parquet"
        path.mkdir(parents=True)
        pq.write_table(spark.createDataFrame(rows, schema).toArrow(), str(path / "part.parquet"))
        os.utime(path / "part.parquet", (1_700_000_000 + 60 * i,) * 2)
    stream = read_events_stream(spark, f"{src}/*/", 1)
    start_sessions_sink(sessionize_exact(stream, watermark=watermark), out).awaitTermination(300)
    return spark.read.parquet(out).select(*DIMS)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_stream_six_hours_late_rows_and_merges(spark, tmp_path):
    t = datetime(2024, 1, 1, 8)
    h = timedelta(hours=1)
    us = timedelta(microseconds=1)
    ev = [(1, t, 1, "view", 0.0, '{"k": 3}'), (2, t + 6 * h, 1, "click", 0.0, '{"k": 4}'),            # exactly 6 h: one session
          (3, t + 12 * h + us, 1, "purchase", 0.0, '{"k": 1}'),                                       # a microsecond more: the next
          (4, t, 2, "view", 0.0, '{"k": 2}'), (5, t + 10 * h, 2, "view", 0.0, '{"k": 7}'),
          (6, t, 10, "signup", 0.0, None), (7, t + 1 * h, None, "view", 0.0, '{"k": 9}'), (8, None, 3, "view", 0.0, None)]
    bridge = [(9, t + 5 * h, 2, "click", 0.0, '{"k": 8}'), (9, t + 5 * h, 2, "click", 0.0, '{"k": 8}'),   # late: joins two open ones
              (10, t - 1 * h, 1, "error", 0.0, '{"k": 6}')]                                              # late: a new first event
    end = [(11, t + 100 * h, 77, "view", 0.0, '{"k": 5}')]
    got = _run_exact(spark, tmp_path, [ev, bridge, end, [(12, t + 200 * h, 77, "view", 0.0, '{"k": 5}')]])
    batch = spark.createDataFrame([r for r in ev + bridge + end if r[1] is not None], SCHEMAS["events"])
    assert _rows(got) == _rows(sessions_from_events(batch).select(*DIMS))


def test_exact_stream_in_shuffled_batches_equals_batch(spark, tmp_path):
    rows = [tuple(r) for r in read_table(spark, SF_SMALL, "events").collect()]
    rows.sort(key=lambda r: r[1])
    rng = random.Random(5)
    cuts = [rows[i:i + 200] for i in range(0, len(rows), 200)]
    for a, b in zip(cuts, cuts[1:]):                     # rows up to some days late, under a delay that covers them
        for _ in range(40):
            i, j = rng.randrange(len(a)), rng.randrange(len(b))
            a[i], b[j] = b[j], a[i]
    last = max(r[1] for r in rows)
    cuts.append([(-1, last + timedelta(days=60), -7, "view", 0.0, None)])
    cuts.append([(-2, last + timedelta(days=120), -7, "view", 0.0, None)])
    got = _run_exact(spark, tmp_path, cuts, "20 days").where("user_id <> -7")
    assert _rows(got) == _rows(sessions_from_events(read_table(spark, SF_SMALL, "events")).where("user_id is not null").select(*DIMS))


def test_intervals_merge_like_events_in_any_order():
    rng = random.Random(11)
    for _ in range(200):
        gap = rng.randrange(1, 6)
        ev = [(rng.randrange(40), i, rng.randrange(9)) for i in range(rng.randrange(1, 15))]
        want, run = [], []
        for e in sorted(ev):
            if run and e[0] - run[-1][0] > gap:
                want.append(run)
                run = []
            run.append(e)
        want.append(run)
        rng.shuffle(ev)
        held = []
        for i in range(0, len(ev), 4):
            pdf = pd.DataFrame(ev[i:i + 4], columns=["us", "event_id", "k"]).assign(event_type="view")
            held = merge_intervals(held + _intervals(pdf, gap), gap)
        assert [(s[0], s[1], s[2], s[3], s[4]) for s in held] == [(r[0][0], r[-1][0], r[0][1], r[0][2], len(r)) for r in want]


def test_users_share_a_group_but_not_their_sessions(spark):
    from kpilens.streaming.exact_sessions import GROUPS, STATE, _by_user
    big = (1 << 62) + 1                                                              # not exact in a double
    rows = pd.DataFrame([(big, False, 0, 1.0, 3, "view"), (0, True, 5, None, 4, "click"), (0, False, 5, 2.0, 5, "view"),
                         (big - 1, False, 1, 3.0, 6, "view"), (big, False, 100, 4.0, 7, "purchase"), (big, False, 7, 5.0, 8, "click")],
                        columns=["user", "anon", "us", "event_id", "k", "event_type"])
    got = _by_user(rows, 10)
    assert {w: [s[:5] for s in parts] for w, parts in got.items()} == {
        (big, False): [(0, 7, 1, 3, 2), (100, 100, 4, 7, 1)], (big - 1, False): [(1, 1, 3, 6, 1)],
        (0, False): [(5, 5, 2, 5, 1)], (0, True): [(5, 5, None, 4, 1)]}
    assert STATE.startswith("user ") and GROUPS == 4096
