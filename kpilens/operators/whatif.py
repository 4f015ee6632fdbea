"""What-if transforms on tables (tables -> tables; the base is never modified).

Randomness is replaced by md5 of the key, so a rerun gives the same edit. An
edited data set is an `EditedStar`: the same logical schema with some tables
replaced, so every KPI operator runs on it unchanged.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpilens.config import LOST_STATUSES
from kpilens.functions.columns import epoch_micros, fact_months, money, month_range
from kpilens.functions.quantiles import values_at_ranks
from kpilens.operators.sessions import split_by_gap
from kpilens.session import ensure_checkpoint_dir, kept
from kpilens.sources.tables import Star

DAY = 86400


class EditedStar(Star):
    """A Star whose logical tables may be replaced (orders, order_items, users, events)."""

    def __init__(self, base: Star, **tables: DataFrame):
        super().__init__(base.spark, base.sf_dir, base.today)
        self.__dict__["raw"] = base.raw
        self._base = base
        self._over = dict(getattr(base, "_over", {}), **tables)

    @property
    def orders(self) -> DataFrame:
        return self._over["orders"] if "orders" in self._over else super().orders

    @property
    def order_items(self) -> DataFrame:
        return self._over["order_items"] if "order_items" in self._over else super().order_items

    @property
    def users(self) -> DataFrame:
        return self._over["users"] if "users" in self._over else super().users

    @property
    def events(self) -> DataFrame:
        return self._over["events"] if "events" in self._over else super().events


def key_hash(key: Column | str, digits: int = 13) -> Column:
    """Deterministic pseudo-random order: the first 52 bits of md5 of the key (exact in a double)."""
    k = key if isinstance(key, Column) else F.col(key)
    return F.conv(F.substring(F.md5(k.cast("string")), 1, digits), 16, 10).cast("long")


# ---------------------------------------------------------------- J1 / J2 / J3
def orders_of_source(star: Star, month: str | list[str], source: str) -> DataFrame:
    """Orders of a period whose user came from one acquisition source."""
    u = star.users.filter(F.col("traffic_source") == source).select(F.col("id").alias("user_id"))
    return star.orders.filter(month_range("created_at", month)).join(u, "user_id", "left_semi")


def orders_all_from_segment(fact: DataFrame, month: str | list[str], dim: str = "dist_center",
                            segment: str | None = None) -> DataFrame:
    """Orders of a period, not already lost, whose items ALL come from one segment
    (relational division: count of items in the segment = count of items). Without a
    segment, the segment with the most such orders (ties: name) is taken."""
    f = fact.filter(fact_months(month) & ~F.col("lost"))
    per = f.groupBy("order_id", "month").agg(F.min(dim).alias("segment"), F.countDistinct(dim).alias("_k"))
    cand = per.filter(F.col("_k") == 1).drop("_k")
    if segment is not None:
        return cand.filter(F.col("segment") == segment)
    top = (cand.groupBy("segment").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_r", F.row_number().over(Window.orderBy(F.desc("_n"), "segment")))   # segment grain
               .filter("_r = 1").select("segment"))
    return cand.join(top, "segment")


def sample_exact(df: DataFrame, key: str, rate: float, by: list[str] | tuple = ()) -> DataFrame:
    """Exactly round(rate * n) rows per group (half to even), without replacement,
    chosen by md5 order of the key. The cut is the hash value at rank k-1, found with
    the distributed rank selection (no group is sorted in one task); rows that tie on
    the hash at the cut are few and are ranked by key. The hashed input is read five
    times, so it is checkpointed once (reliable storage: the lineage is cut, and a lost
    executor does not force the upstream joins to run again)."""
    by = list(by)
    if not 0 <= rate <= 1:
        raise ValueError(f"a sampling rate lies between 0 and 1, not at {rate}")
    ensure_checkpoint_dir(df.sparkSession)
    h = df.withColumn("_h", key_hash(key)).checkpoint(eager=True)
    n = h.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    k = n.withColumn("_take", F.bround(F.lit(float(rate)) * F.col("_n"), 0).cast("long"))
    ranks = k.filter(F.col("_take") > 0).select(*by, (F.col("_take") - 1).alias("_k"))
    cut = values_at_ranks(h, "_h", ranks, by).select(*by, F.col("_v").cast("long").alias("_cut"))
    cut = cut.join(k.select(*by, "_take"), by) if by else cut.crossJoin(k.select("_take"))
    j = h.join(cut, by) if by else h.crossJoin(cut)          # without groups: one row
    below = j.filter(F.col("_h") < F.col("_cut"))
    n_below = below.groupBy(*by).agg(F.count(F.lit(1)).alias("_nb"))
    ties = j.filter(F.col("_h") == F.col("_cut"))
    ties = ties.join(n_below, by, "left") if by else ties.crossJoin(n_below)
    ties = (ties.withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_h").orderBy(key)))
                .filter(F.col("_r") <= F.col("_take") - F.coalesce("_nb", F.lit(0))))
    cols = df.columns
    return below.select(*cols).unionByName(ties.select(*cols))


# ---------------------------------------------------------------- J4 / J5
def _lost_before(orders: DataFrame) -> Column:
    return F.coalesce(F.col("status").isin(*LOST_STATUSES), F.lit(False))


def flip_to_returned(star: Star, picked: DataFrame) -> tuple[EditedStar, DataFrame]:
    """Set status Returned on the picked orders (items carry their order's status).
    Report: orders flipped, their items, the revenue moved out of net, and how many picks
    were already lost (the reference rejects those; here they are counted)."""
    ids = picked.select("order_id").distinct().withColumn("_pick", F.lit(True))
    o = star.orders.join(ids, "order_id", "left")
    was_lost = _lost_before(o)
    new_orders = o.select("order_id", "user_id",
                          F.when(F.col("_pick"), F.lit("Returned")).otherwise(F.col("status")).alias("status"),
                          "created_at", "total_price")
    flipped = o.filter(F.col("_pick")).select("order_id", was_lost.alias("_was_lost"))
    items = star.order_items.join(flipped, "order_id")
    report = (flipped.agg(F.count(F.lit(1)).alias("orders"),
                          F.sum(F.col("_was_lost").cast("long")).alias("already_lost"))
              .crossJoin(items.agg(F.count(F.lit(1)).alias("items"),
                                   money(F.sum(F.when(~F.col("_was_lost"), F.col("sale_price"))))
                                   .alias("revenue_moved_out_of_net"))))
    return EditedStar(star, orders=new_orders), report


def item_key() -> Column:
    """A unique item key: whole item rows are unique (the (order, line) pair is not), so
    the row's fields joined as text identify it exactly, with no global numbering."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in
                              ("order_id", "line_number", "product_id", "supplier_id", "sale_price", "quantity",
                               "line_status", "created_at")])


def drop_orders(star: Star, picked: DataFrame, sessions: DataFrame | None = None,
                matches: DataFrame | None = None) -> tuple[EditedStar, DataFrame, DataFrame | None]:
    """Orders never happened: remove them, their items and (given the one-to-one
    item -> session matches of the dropped items) the purchase session that produced each item.
    Report: rows before and after, the dropped items' revenue, and with matches the sessions removed
    and the dropped items no session was found for."""
    ids = kept(picked.select("order_id").distinct(), "dropped-orders")
    new_orders = star.orders.join(ids, "order_id", "left_anti")
    new_items = star.order_items.join(ids, "order_id", "left_anti")
    new_sessions = None
    if sessions is not None and matches is not None:
        new_sessions = sessions.join(matches.select("session_id").distinct(), "session_id", "left_anti")
    # one pass a table: a row is either dropped or stays
    mark = ids.withColumn("_gone", F.lit(True))
    gone, n = F.col("_gone"), F.count(F.lit(1))
    heads = star.orders.select("order_id").join(mark, "order_id", "left")
    lines = star.order_items.select("order_id", "sale_price").join(mark, "order_id", "left")
    report = (heads.agg(n.alias("orders_before"), F.count_if(gone.isNull()).alias("orders_after"))
              .crossJoin(lines.agg(n.alias("items_before"), F.count_if(gone.isNull()).alias("items_after"),
                                   F.coalesce(money(F.sum(F.when(gone, F.col("sale_price")))), F.lit(0.0)).alias("revenue_removed"))))
    if new_sessions is not None:
        report = report.crossJoin(matches.agg(F.count(F.lit(1)).alias("sessions_removed")))      # one per matched item
        report = report.withColumn("items_without_session", F.col("items_before") - F.col("items_after") - F.col("sessions_removed"))
    return EditedStar(star, orders=new_orders, order_items=new_items), report, new_sessions


# ---------------------------------------------------------------- J6
def _micros(c: str) -> Column:
    return epoch_micros(c)


def session_candidates(items: DataFrame, sessions: DataFrame, before_days: int = 3,
                       after_days: int = 1) -> DataFrame:
    """Interval join: for each item (item_id, user_id, ts) the sessions (session_id,
    user_id, started_at) of the same user with started_at in [ts - before, ts + after].
    Banded: each item is expanded to the day buckets its window covers and joined on
    (user_id, day) - never the user's full cross product."""
    lo = F.floor((_micros("ts") - before_days * DAY * 1_000_000) / (DAY * 1_000_000)).cast("long")
    hi = F.floor((_micros("ts") + after_days * DAY * 1_000_000) / (DAY * 1_000_000)).cast("long")
    it = items.select("item_id", "user_id", "ts", F.explode(F.sequence(lo, hi)).alias("_day"))
    s = sessions.filter(F.col("user_id").isNotNull()).select(
        "session_id", "user_id", "started_at",
        F.floor(_micros("started_at") / (DAY * 1_000_000)).cast("long").alias("_day"))
    dt = _micros("started_at") - _micros("ts")
    return (it.join(s, ["user_id", "_day"])
              .filter((dt >= -before_days * DAY * 1_000_000) & (dt <= after_days * DAY * 1_000_000))
              .select("item_id", "user_id", "ts", "session_id", "started_at", F.abs(dt).alias("abs_us")))


def nearest_session(items: DataFrame, sessions: DataFrame, before_days: int = 3, after_days: int = 1) -> DataFrame:
    """J6, many-to-one form: each item's nearest session in the window (ties: earlier
    start, then session id). A per-item top-1 over the banded candidates."""
    c = session_candidates(items, sessions, before_days, after_days)
    w = Window.partitionBy("item_id").orderBy("abs_us", "started_at", "session_id")
    return c.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select("item_id", "user_id", "session_id",
                                                                              "abs_us")


def _match_in_order(batches, before_us: int, after_us: int):
    """Sessions and items of each run in time order (a session comes in `after` before its start): every item
    takes the nearest unused session (ties: earlier start, then id). Only the sessions an item could still take are
    held, ordered by (start, id); the state goes on from batch to batch."""
    run, unused = None, []
    for b in batches:
        out = []
        for user, no, at, item, session in zip(b["user_id"], b["run"], b["at_us"], b["item_id"], b["session_id"]):
            if (user, no) != run:
                run, unused = (user, no), []
            if unused and unused[0][0] < at - before_us:
                del unused[:bisect_left(unused, (at - before_us, ""))]
            if item is None:
                insort(unused, (at + after_us, session))
                continue
            later = bisect_left(unused, (at, ""))
            best = bisect_left(unused, (unused[later - 1][0], "")) if later else None
            if later < len(unused) and (best is None or unused[later][0] - at < at - unused[best][0]):
                best = later
            if best is not None:
                out.append((item, user, unused.pop(best)[1]))
        yield pd.DataFrame(out, columns=["item_id", "user_id", "session_id"])


def nearest_session_1to1(items: DataFrame, sessions: DataFrame, before_days: int = 3,
                         after_days: int = 1) -> DataFrame:
    """J6, one-to-one form: per user, items in time order each take the nearest UNUSED session. Sessions and
    items of a user are one timeline, cut wherever nothing happens for longer than the window (no session
    before the cut can be taken after it; `split_runs`, bucketed, no per-user window). The runs are dealt out and
    streamed in order past a set of the sessions still in reach: memory does not grow with a run,
    and no item is paired with more than two sessions. Rows without a user match nothing."""
    reach = F.expr(f"INTERVAL '{after_days}' DAY")
    sessions = sessions.join(items.select("user_id").distinct(), "user_id", "left_semi")       # no item, no match
    item_type = items.schema["item_id"].dataType
    no_item, no_session = F.lit(None).cast(item_type), F.lit(None).cast("string")
    line = (sessions.select("user_id", (F.col("started_at") - reach).alias("at"), no_item.alias("item"), "session_id")
            .unionByName(items.select("user_id", F.col("ts").alias("at"), F.col("item_id").alias("item"), no_session.alias("session_id")))
            .filter(F.col("user_id").isNotNull() & F.col("at").isNotNull())
            .withColumn("id", F.coalesce("session_id", F.col("item").cast("string"))))
    runs = split_by_gap(line, "user_id", "at", "id", (before_days + after_days) * DAY, out="run")
    ordered = (runs.withColumn("at_us", _micros("at")).repartition("user_id", "run")
               .sortWithinPartitions("user_id", "run", "at_us", F.col("item").asc_nulls_first(), "session_id")
               .select("user_id", "run", "at_us", F.col("item").cast("string").alias("item_id"), "session_id"))
    user_type = items.schema["user_id"].dataType.simpleString()
    day = DAY * 1_000_000

    def match(batches):
        return _match_in_order(batches, before_days * day, after_days * day)
    found = ordered.mapInPandas(match, f"item_id string, user_id {user_type}, session_id string")
    return found.withColumn("item_id", F.col("item_id").cast(item_type))


# ---------------------------------------------------------------- J7
def surge(star: Star, month: str, source: str, multiplier: float, new_users: bool = True
          ) -> tuple[EditedStar, DataFrame]:
    """Add round((multiplier - 1) * n) orders shaped like the n orders of `month` from
    acquisition `source`, with their items. Whole copies for the integer part of the
    extra; the fractional remainder is an exact md5-ordered sample. New keys need no
    global ranking: new id = max id + (copy - 1) * span + (id - min id + 1), where span
    is the source ids' range. With `new_users`, each copy gets a new user copied from
    the source user (a first order, so customer type keeps its mix)."""
    if multiplier < 1:
        raise ValueError(f"a surge multiplies by 1 or more, not by {multiplier}")
    pool = orders_of_source(star, month, source)
    whole = int(math.floor(multiplier - 1))
    frac = multiplier - 1 - whole
    ids = pool.agg(F.min("order_id").alias("_min"), F.max("order_id").alias("_pmax"))
    mx = star.orders.agg(F.max("order_id").alias("_omax")).crossJoin(
        star.users.agg(F.max("id").alias("_umax")))
    numbers = F.array(*[F.lit(i) for i in range(1, whole + 1)]).cast("array<int>")      # none at 1.0: no copies, same schema
    copies = pool.select("*", F.explode(numbers).alias("copy"))
    if frac > 0:
        copies = copies.unionByName(sample_exact(pool, "order_id", frac).withColumn("copy", F.lit(whole + 1)))
    c = copies.crossJoin(ids).crossJoin(mx)          # one-row frames
    span = F.col("_pmax") - F.col("_min") + 1
    new_id = F.col("_omax") + (F.col("copy") - 1) * span + (F.col("order_id") - F.col("_min") + 1)
    new_uid = (F.col("_umax") + (F.col("copy") - 1) * span + (F.col("order_id") - F.col("_min") + 1)) \
        if new_users else F.col("user_id")
    new_orders = c.select(new_id.alias("order_id"), new_uid.alias("user_id"), "status", "created_at",
                          "total_price", F.col("order_id").alias("source_order_id"),
                          F.col("user_id").alias("source_user_id"))
    new_items = (star.order_items.join(new_orders.select(F.col("source_order_id").alias("order_id"),
                                                         F.col("order_id").alias("_new")), "order_id")
                 .withColumn("order_id", F.col("_new")).drop("_new"))
    orders = star.orders.unionByName(new_orders.drop("source_order_id", "source_user_id"))
    items = star.order_items.unionByName(new_items.select(*star.order_items.columns))
    over = {"orders": orders, "order_items": items}
    if new_users:
        u = star.users
        nu = (new_orders.select(F.col("user_id").alias("_nid"), F.col("source_user_id").alias("id"))
              .join(u, "id").withColumn("id", F.col("_nid")).drop("_nid"))
        over["users"] = u.unionByName(nu.select(*u.columns))
    return EditedStar(star, **over), new_orders


def planted_delta(base: Star, new_orders: DataFrame) -> DataFrame:
    """The declared change of a surge per month: revenue, net revenue, orders, items
    (computed from the BASE items of each copied source order)."""
    m = new_orders.select(F.col("source_order_id").alias("order_id"), F.col("order_id").alias("_new"), "status",
                          F.date_format("created_at", "yyyy-MM").alias("month"))
    it = base.order_items.join(m, "order_id")
    lost = F.coalesce(F.col("status").isin(*LOST_STATUSES), F.lit(False))
    zero = F.lit(0).cast("decimal(18,2)")
    return it.groupBy("month").agg(money(F.sum("sale_price")).alias("revenue"),
                                   money(F.sum(F.when(~lost, F.col("sale_price")).otherwise(zero))).alias("net_revenue"),
                                   F.countDistinct("_new").alias("orders"), F.count(F.lit(1)).alias("items"))
