"""Sessionise raw events, and the gap-split helper it is built on.

A session of a user ends when the gap to the user's previous event exceeds the
threshold. The obvious plan, `lag(ts)` over `partitionBy(user)`, sends every
event of a hot user to one task. Here the window is keyed by (user, time bucket)
instead, with buckets shorter than the gap:

1. per (user, bucket): last event time (partial aggregate);
2. per user, over BUCKET rows only: the previous non-empty bucket's last time;
3. per (user, bucket) window: previous event = lag, or step 2's carry for the
   first event of the bucket -> new-session flag;
4. per (user, bucket): number of session starts; running sum over bucket rows
   gives each bucket's offset -> session number = offset + running count.

Steps 2 and 4 see one row per active bucket, so a hot user costs at most one row
per bucket of its time span; the event-level windows are keyed by (user, bucket).
`split_runs` is the general form (a row reaches some time; the next row past it
starts a new run), used also to cut the one-to-one session match into independent
parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpilens.config import ANON_USER_MODULO, SESSION_GAP_HOURS
from kpilens.functions.columns import epoch_micros

BUCKET_SECONDS = 900


def _micros(ts: Column) -> Column:
    return epoch_micros(ts)


def split_runs(df: DataFrame, key: str, ts: str, tiebreak: str, reach_us: Column,
               bucket_seconds: int = BUCKET_SECONDS, out: str = "session_no") -> DataFrame:
    """Number the runs of `df` per `key` in (ts, tiebreak) order: a row starts a new run
    when its time is past the previous row's `reach` (microseconds). Adds `out` (1-based)
    and `is_start`. Windows are keyed by (key, time bucket); the carry into a bucket is
    the reach of the last row of the key's previous non-empty bucket, found over
    bucket rows only."""
    b = F.floor(_micros(F.col(ts)) / (bucket_seconds * 1_000_000)).cast("long")
    e = df.withColumn("_b", b).withColumn("_reach", reach_us)
    last_in_bucket = e.groupBy(key, "_b").agg(F.max_by("_reach", F.struct(ts, tiebreak)).alias("_last"))
    per_key = Window.partitionBy(key).orderBy("_b")            # bucket rows only
    carry = last_in_bucket.select(key, "_b", F.lag("_last").over(per_key).alias("_carry"))
    e = e.join(carry, [key, "_b"])
    w = Window.partitionBy(key, "_b").orderBy(ts, tiebreak)
    prev = F.coalesce(F.lag("_reach").over(w), F.col("_carry"))
    e = e.withColumn("is_start", prev.isNull() | (_micros(F.col(ts)) > prev))
    e = e.withColumn("_run", F.sum(F.col("is_start").cast("long")).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    starts = e.groupBy(key, "_b").agg(F.sum(F.col("is_start").cast("long")).alias("_n"))
    offs = starts.select(key, "_b", (F.sum("_n").over(per_key.rowsBetween(Window.unboundedPreceding, 0))
                                     - F.col("_n")).alias("_off"))
    return (e.join(offs, [key, "_b"])
             .withColumn(out, F.col("_off") + F.col("_run"))
             .drop("_b", "_carry", "_run", "_off", "_reach"))


def split_by_gap(df: DataFrame, key: str, ts: str, tiebreak: str, gap_seconds: int,
                 bucket_seconds: int = BUCKET_SECONDS, out: str = "session_no") -> DataFrame:
    """Runs per `key`: a new run starts when the time since the previous row of the same
    key (ordered by ts, tiebreak) exceeds `gap_seconds` (each row reaches ts + gap)."""
    reach = _micros(F.col(ts)) + F.lit(gap_seconds * 1_000_000)
    return split_runs(df, key, ts, tiebreak, reach, min(bucket_seconds, gap_seconds), out)


def sessions_from_events(events: DataFrame, gap_hours: int = SESSION_GAP_HOURS, cutoff: str | None = None) -> DataFrame:
    """One row per session: dimensions of the session's first event ((ts, event_id) order,
    deterministic where ANY_VALUE is not), start, event count and the three "ever happened" flags.
    `cutoff` keeps events before that time. Fixture mapping: session source / browser from the `k`
    property, anonymous when user_id % 10 = 0, period = ISO week.

    A time bucket is never longer than the gap, so a session can only start at a bucket's first
    event: events are combined per (user, bucket) map-side, and gaps are looked for between bucket
    rows. One scan, one exchange by bucket and one by user; no event-level window or join."""
    gap = gap_hours * 3_600_000_000
    width = min(BUCKET_SECONDS * 1_000_000, gap)
    e = events if cutoff is None else events.where(F.col("ts") < F.lit(cutoff).cast("timestamp_ntz"))
    k = F.get_json_object("props", "$.k").cast("long")
    cells = (e.groupBy("user_id", F.floor(_micros(F.col("ts")) / F.lit(width)).cast("long").alias("_b"))
              .agg(F.min(F.struct("ts", "event_id", k.alias("k"))).alias("_first"), F.max("ts").alias("_last"),
                   F.count(F.lit(1)).alias("_n"),
                   *[F.bool_or(F.col("event_type") == t).alias(f"_{t}") for t in ("view", "click", "purchase")]))
    per_user = Window.partitionBy("user_id").orderBy("_b")            # bucket rows only
    before = F.lag("_last").over(per_user)
    fresh = before.isNull() | (_micros(F.col("_first.ts")) - _micros(before) > gap)
    runs = cells.withColumn("_fresh", fresh.cast("long")).withColumn("session_no", F.sum("_fresh").over(per_user))
    s = (runs.groupBy("user_id", "session_no")
             .agg(F.min("_first").alias("_f"), F.sum("_n").alias("n_events"), F.bool_or("_view").alias("saw_product"),
                  F.bool_or("_click").alias("added_to_cart"), F.bool_or("_purchase").alias("purchased"))
             .withColumn("k", F.col("_f.k")).withColumn("started_at", F.col("_f.ts")))
    return s.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("session_no").cast("string")).alias("session_id"),
        F.when(F.col("user_id") % ANON_USER_MODULO != 0, F.col("user_id")).alias("user_id"),
        F.concat(F.lit("S"), (F.col("k") % 5).cast("string")).alias("traffic_source"),
        F.concat(F.lit("B"), (F.col("k") % 4).cast("string")).alias("browser"),
        "started_at", "n_events", "saw_product", "added_to_cart", "purchased",
        F.date_format(F.date_trunc("week", "started_at"), "yyyy-MM-dd").alias("period"))


def complete_periods(sessions: DataFrame) -> DataFrame:
    """Session periods strictly before the period of the newest session (R1 for weeks);
    period grain, a window over all period rows."""
    p = sessions.select("period").distinct()
    return (p.withColumn("_cut", F.max("period").over(Window.partitionBy()))
             .filter(F.col("period") < F.col("_cut")).select("period"))
