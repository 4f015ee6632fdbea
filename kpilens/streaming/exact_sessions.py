"""B7 as a stream with the batch rule: a session ends when the gap exceeds the threshold.

`session_window` splits at a gap >= the threshold, so the rule needs state of its own. Per user the
state holds the sessions that can still grow, as intervals (first event, last event, counts, flags) and
never as events: a batch's rows become intervals in one sorted pass, and intervals at most one gap apart
merge, so events may come in any order. An interval is emitted once last + gap lies before the watermark,
when no row that is not too late can reach it; then it leaves the state, and a user without open
intervals leaves it too. State is bounded by the watermark delay over the gap per user, not by the events, and a
hot user's rows arrive in Arrow batches.

The state's key is one of `GROUPS` hash groups of users, not the user: Python is called once per group and batch
and cuts all its users' rows in one pass, where a call, a frame and a timer per user cost more than the
rows. A timer on the interval of the group that ends first closes it without further events.

Times are microseconds of the wall clock in UTC, so neither the session time zone nor a change of clocks moves a
border. Rows without a time are left out; a null user is one user, as in batch. Rows later than the watermark are
dropped by Spark. A repeated row counts again, as in batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kpilens.config import ANON_USER_MODULO, SESSION_GAP_HOURS
from kpilens.functions.columns import epoch_micros

GROUPS = 4096                      # fixed, since the stored state is keyed by it
STATE = ("user array<long>, anon array<boolean>, first_us array<long>, last_us array<long>, first_id array<long>, k array<long>, n array<long>, "
         "view array<boolean>, click array<boolean>, purchase array<boolean>")
CLOSED = "raw_user_id long, k long, first_us long, last_us long, n_events long, view boolean, click boolean, purchase boolean"
FLAGS = ("view", "click", "purchase")


def _intervals(pdf: pd.DataFrame, gap_us: int) -> list[tuple]:
    """The rows as intervals (first_us, last_us, first_id, k, n, flags...), in time order."""
    return [s for found in _by_user(pdf.assign(user=0, anon=False), gap_us).values() for s in found]


def _by_user(pdf: pd.DataFrame, gap_us: int) -> dict[tuple[int, bool], list[tuple]]:
    """The intervals of each user (number, is it the null user) of the rows."""
    d = pdf.sort_values(["anon", "user", "us", "event_id"], kind="stable", na_position="first")
    us, user, anon = d["us"].to_numpy("int64"), d["user"].to_numpy("int64"), d["anon"].to_numpy(bool)
    if not len(us):
        return {}
    at = np.flatnonzero(np.r_[True, (np.diff(us) > gap_us) | (user[1:] != user[:-1]) | (anon[1:] != anon[:-1])])
    last = us[np.r_[at[1:] - 1, len(us) - 1]]
    n = np.diff(np.r_[at, len(us)])
    kinds = d["event_type"].to_numpy()
    flags = [np.logical_or.reduceat(kinds == f, at) for f in FLAGS]
    ids, ks = d["event_id"].to_numpy()[at], d["k"].to_numpy()[at]
    out: dict[tuple[int, bool], list[tuple]] = {}
    for j, i in enumerate(at):
        s = (int(us[i]), int(last[j]), _whole(ids[j]), _whole(ks[j]), int(n[j]), *(bool(f[j]) for f in flags))
        out.setdefault((int(user[i]), bool(anon[i])), []).append(s)
    return out


def _whole(x) -> int | None:
    return None if pd.isna(x) else int(x)


def _rank(s: tuple) -> tuple:
    return s[0], s[2] is not None, s[2] or 0            # a missing id sorts first, as in Spark


def merge_intervals(parts: list[tuple], gap_us: int) -> list[tuple]:
    """Intervals at most `gap_us` apart become one; its dimensions are those of its first event."""
    out: list[tuple] = []
    for s in sorted(parts, key=_rank):
        if out and s[0] - out[-1][1] <= gap_us:
            a = out[-1]
            out[-1] = (a[0], max(a[1], s[1]), a[2], a[3], a[4] + s[4], *(x or y for x, y in zip(a[5:], s[5:])))
        else:
            out.append(s)
    return out


def _step(gap_us: int):
    def step(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, bool], list[tuple]] = {}
        for user, anon, *s in zip(*state.get) if state.exists else ():
            held.setdefault((user, anon), []).append(tuple(s))
        if not state.hasTimedOut:
            for pdf in pdfs:
                for who, new in _by_user(pdf, gap_us).items():
                    held[who] = merge_intervals(held[who] + new, gap_us) if who in held else new
        limit = state.getCurrentWatermarkMs() * 1000
        rows = [(*who, *s) for who, parts in held.items() for s in parts]
        closed = [s for s in rows if s[3] + gap_us < limit]
        still = [s for s in rows if s[3] + gap_us >= limit]
        if still:
            state.update(tuple(list(c) for c in zip(*still)))
            state.setTimeoutTimestamp((min(s[3] for s in still) + gap_us) // 1000)
        elif state.exists:
            state.remove()
        if closed:
            out = pd.DataFrame(closed, columns=["user", "anon", "first_us", "last_us", "first_id", "k", "n_events", *FLAGS])
            out["k"] = out["k"].astype("Int64")
            out["raw_user_id"] = out["user"].astype("Int64").mask(out["anon"])
            yield out[["raw_user_id", "k", "first_us", "last_us", "n_events", *FLAGS]]
    return step


def sessionize_exact(events: DataFrame, gap_hours: int = SESSION_GAP_HOURS, watermark: str = "1 day") -> DataFrame:
    """Streaming sessions under the rule of `sessions_from_events`: one row per closed session, append mode."""
    us = epoch_micros(F.col("ts"))
    e = (events.where(F.col("ts").isNotNull())
               .select(F.pmod(F.xxhash64("user_id"), F.lit(GROUPS)).alias("users"), F.coalesce("user_id", F.lit(0)).alias("user"),
                       F.col("user_id").isNull().alias("anon"), "event_id", "event_type", us.alias("us"), F.timestamp_micros(us).alias("event_time"),
                       F.get_json_object("props", "$.k").cast("long").alias("k"))
               .withWatermark("event_time", watermark))
    s = e.groupBy("users").applyInPandasWithState(_step(gap_hours * 3_600_000_000), CLOSED, STATE, "append",
                                                    GroupStateTimeout.EventTimeTimeout)
    wall = F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, cast(first_us / 1000000BD as decimal(18, 6)))")
    s = s.withColumn("started_at", wall)
    return s.select(
        "raw_user_id", F.when(F.col("raw_user_id") % ANON_USER_MODULO != 0, F.col("raw_user_id")).alias("user_id"),
        F.concat(F.lit("S"), (F.col("k") % 5).cast("string")).alias("traffic_source"),
        F.concat(F.lit("B"), (F.col("k") % 4).cast("string")).alias("browser"),
        "started_at", "n_events", F.col("view").alias("saw_product"), F.col("click").alias("added_to_cart"),
        F.col("purchase").alias("purchased"), F.date_format(F.date_trunc("week", "started_at"), "yyyy-MM-dd").alias("period"))
