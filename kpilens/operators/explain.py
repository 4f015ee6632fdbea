"""Explaining a change.

Segment work is one pass over the fact: the rows of both periods are expanded
to (dimension, segment) pairs with `inline` (the Expand of GROUPING SETS), then
one hash aggregate with partial combine. Shares, lifts and ranks are windows over
the aggregated segment rows (bounded by the dimension cardinalities).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpilens.config import (DEFAULT_RULES, DIMENSIONS, LEAKAGE_HISTORY, LEAKAGE_SIGMA, SEGMENT_RATIO,
                            Rules, check_dimension, check_measure)
from kpilens.functions.columns import fact_months, lift_parts, money, ratio

DIM_ORDER = {d: i for i, d in enumerate(DIMENSIONS)}


# ---------------------------------------------------------------- F1
def decompose(monthly: DataFrame, prev: list[str], cur: list[str]) -> DataFrame:
    """Volume effect = d_orders * aov_prev; aov effect = orders_cur * d_aov; they sum
    to the revenue change exactly. Both periods' totals come from one conditional
    aggregate over the month rows (no join)."""
    in_a, in_b = F.col("month").isin(*prev), F.col("month").isin(*cur)
    t = monthly.agg(F.sum(F.when(in_a, F.col("revenue"))).alias("a_revenue"),
                    F.sum(F.when(in_a, F.col("orders"))).alias("a_orders"),
                    F.sum(F.when(in_b, F.col("revenue"))).alias("b_revenue"),
                    F.sum(F.when(in_b, F.col("orders"))).alias("b_orders"))
    a_aov, b_aov = ratio("a_revenue", "a_orders"), ratio("b_revenue", "b_orders")
    delta = F.col("b_revenue") - F.col("a_revenue")
    vol = (F.col("b_orders") - F.col("a_orders")) * a_aov
    aov = F.col("b_orders") * (b_aov - a_aov)
    return t.select(F.lit(",".join(prev)).alias("prev"), F.lit(",".join(cur)).alias("cur"),
                    F.col("a_revenue").alias("revenue_prev"), F.col("b_revenue").alias("revenue_cur"),
                    delta.alias("delta"), ratio(delta, "a_revenue").alias("delta_pct"),
                    vol.alias("volume_effect"), aov.alias("aov_effect"),
                    F.when(delta != 0, vol / delta).alias("volume_share"),
                    F.when(delta != 0, aov / delta).alias("aov_share"))


# ---------------------------------------------------------------- F2-F4
def _z(value: Column, mean: Column, sd: Column, rules: Rules) -> tuple[Column, Column]:
    z = F.when(sd != 0, (value - mean) / sd)
    # SURVEY 7.4 item 13: sd = 0 and a different value counts as unusual (infinite z)
    flat_jump = (sd == 0) & (value != mean)
    unusual = F.coalesce((F.abs(z) >= rules.unusual_z) | flat_jump, F.lit(False))
    return z, unusual


def zscore_table(monthly: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """F2 for every month: z of the MoM growth against the mean and SAMPLE sd of the
    `lookback` rows before it (the first month's NULL MoM is skipped by the aggregates).
    z is NULL when fewer than `min_history` months precede (the point API raises)."""
    w = Window.orderBy("month").rowsBetween(-rules.lookback, -1)   # month grain
    t = monthly.select("month", "mom",
                       F.count("mom").over(w).alias("history"),
                       F.avg("mom").over(w).alias("hist_mean"),
                       F.stddev_samp("mom").over(w).alias("hist_sd"))
    ok = F.col("history") >= rules.min_history
    z, unusual = _z(F.col("mom"), F.col("hist_mean"), F.col("hist_sd"), rules)
    return t.select("month", "mom", "history", "hist_mean", "hist_sd",
                    F.when(ok, z).alias("zscore"), (ok & unusual).alias("unusual"))


def zscore_window(monthly: DataFrame, months: list[str], before: str | None = None,
                  rules: Rules = DEFAULT_RULES) -> DataFrame:
    """every month of `months` judged against ONE baseline, the `lookback` rows before
    `before` (default: the window's first month). Month grain: the baseline statistics
    are windows over all month rows (tens of rows), no join."""
    before = before or months[0]
    allm = Window.partitionBy()                                     # month grain
    idx = monthly.select("month", "mom", F.row_number().over(Window.orderBy("month")).alias("idx"))
    b_idx = F.max(F.when(F.col("month") == before, F.col("idx"))).over(allm)
    t = idx.withColumn("_b", b_idx)
    base_mom = F.when((F.col("idx") < F.col("_b")) & (F.col("idx") >= F.col("_b") - rules.lookback), F.col("mom"))
    t = t.select("month", "mom", F.count(base_mom).over(allm).alias("history"),
                 F.avg(base_mom).over(allm).alias("hist_mean"), F.stddev_samp(base_mom).over(allm).alias("hist_sd"),
                 F.col("_b").isNotNull().alias("_known"))
    t = t.filter(F.col("month").isin(list(months)) & F.col("_known"))
    ok = F.col("history") >= rules.min_history
    z, unusual = _z(F.col("mom"), F.col("hist_mean"), F.col("hist_sd"), rules)
    return t.select("month", "mom", "history", "hist_mean", "hist_sd",
                    F.when(ok, z).alias("zscore"), (ok & unusual).alias("unusual"),
                    F.lit(before).alias("before"))


def unusual_months(monthly: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """months whose |z| >= 2 against their own trailing history."""
    return zscore_table(monthly, rules).filter("unusual").select("month", "mom", "zscore")


# ---------------------------------------------------------------- F5-F10
def segment_periods(fact: DataFrame, prev: list[str], cur: list[str], dims=DIMENSIONS,
                    measure: str | tuple = "revenue") -> DataFrame:
    """One scan, one aggregate: (measure, dimension, segment, prev, cur) for every
    dimension and every requested measure. The period filter is a timestamp range (and
    a month-key filter), so it reaches the orders parquet scan or prunes partitions."""
    measures = (measure,) if isinstance(measure, str) else tuple(measure)
    cols = {m: check_measure(m) for m in measures}
    for d in dims:
        check_dimension(d)
    in_prev = F.col("month").isin(*prev)
    in_cur = F.col("month").isin(*cur)
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("segment"))
                      for d in dims])
    rows = (fact.filter(fact_months(list(prev) + list(cur)))
                .select(F.inline(pairs), in_prev.alias("in_prev"), in_cur.alias("in_cur"),
                        *[F.col(c).alias(f"v_{m}") for m, c in cols.items()]))
    zero = F.lit(0).cast("decimal(18,2)")
    sums = []
    for m in measures:
        sums += [F.sum(F.when(F.col("in_prev"), F.col(f"v_{m}")).otherwise(zero)).alias(f"p_{m}"),
                 F.sum(F.when(F.col("in_cur"), F.col(f"v_{m}")).otherwise(zero)).alias(f"c_{m}")]
    agg = rows.groupBy("dimension", "segment").agg(*sums)
    per_measure = F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"p_{m}").alias("prev"),
                                              F.col(f"c_{m}").alias("cur")) for m in measures]))
    return agg.select("dimension", "segment", per_measure)


def contribution_from(seg: DataFrame) -> DataFrame:
    """Shares and lift per segment; rank by |delta| desc (segment breaks ties)."""
    per_dim = Window.partitionBy("measure", "dimension")          # segment grain
    t = seg.select("measure", "dimension", "segment", "prev", "cur", (F.col("cur") - F.col("prev")).alias("delta"))
    # totals are exact DECIMAL sums; each share is then a single double division
    tot_delta, tot_prev = F.sum("delta").over(per_dim), F.sum("prev").over(per_dim)
    t = t.select("measure", "dimension", "segment", money("prev").alias("prev"), money("cur").alias("cur"),
                 money("delta").alias("delta"),
                 F.when(tot_delta != 0, ratio("delta", tot_delta)).alias("share_of_change"),
                 F.when(tot_prev != 0, ratio("prev", tot_prev)).alias("share_of_base"))
    lift, is_new = lift_parts(F.col("share_of_change"), F.col("share_of_base"))
    rank = F.row_number().over(Window.partitionBy("measure", "dimension").orderBy(F.abs("delta").desc(), "segment"))
    return t.select("dimension", "segment", "measure", "prev", "cur", "delta",
                    "share_of_change", "share_of_base", lift.alias("lift"), is_new.alias("is_new_segment"),
                    rank.alias("rank"))


def contribution(fact: DataFrame, dim: str, prev: list[str], cur: list[str],
                 measure: str = "revenue") -> DataFrame:
    """One dimension."""
    check_dimension(dim)
    return contribution_from(segment_periods(fact, prev, cur, (dim,), measure))


def contribution_all(fact: DataFrame, prev: list[str], cur: list[str], measure: str = "revenue",
                     dims=DIMENSIONS) -> DataFrame:
    """every dimension from one scan."""
    return contribution_from(segment_periods(fact, prev, cur, dims, measure))


def contribution_top(contrib: DataFrame, top: int = 5) -> DataFrame:
    """head `top` per dimension (WindowGroupLimit keeps this a per-group top-k)."""
    return contrib.filter(F.col("rank") <= top)


def total_change_guard(monthly: DataFrame, prev: list[str], cur: list[str], measure: str = "revenue",
                       rules: Rules = DEFAULT_RULES) -> DataFrame:
    """R11 guard as one row from the month rows: look for drivers only when |b - a| / a >= 2 %."""
    check_measure(measure)
    t = monthly.agg(F.sum(F.when(F.col("month").isin(*prev), F.col(measure))).alias("total_prev"),
                    F.sum(F.when(F.col("month").isin(*cur), F.col(measure))).alias("total_cur"))
    change = F.when(F.col("total_prev") != 0,
                    F.abs(F.col("total_cur") - F.col("total_prev")) / F.col("total_prev"))
    return t.select(F.lit(measure).alias("measure"), "total_prev", "total_cur", change.alias("total_change"),
                    F.coalesce(change >= rules.min_total_change, F.lit(False)).alias("look_for_drivers"))


def drivers_from(contrib: DataFrame, guard: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """F8 rule on a contribution frame: |share| >= 0.15 AND |lift - 1| >= 0.5 (an
    infinite lift passes, an undefined one never does), only when the measure's guard
    allows. Order per measure: |share| desc, ties in dimension order, then rank."""
    dim_pos = F.create_map(*[x for d, i in DIM_ORDER.items() for x in (F.lit(d), F.lit(i))])
    hit = ((F.abs("share_of_change") >= rules.min_share)
           & (F.col("is_new_segment") | (F.abs(F.col("lift") - 1) >= rules.min_lift_gap)))
    d = (contrib.join(F.broadcast(guard.select("measure", "look_for_drivers")), "measure")   # one row per measure
                .filter(F.col("look_for_drivers") & F.coalesce(hit, F.lit(False)))
                .drop("look_for_drivers"))
    order = Window.partitionBy("measure").orderBy(F.abs("share_of_change").desc(), dim_pos[F.col("dimension")],
                                                  F.col("rank"))
    return d.select("dimension", "segment", "measure", "delta", "share_of_change", "share_of_base", "lift",
                    "is_new_segment", F.row_number().over(order).alias("driver_rank"))


def guard_from_segments(seg: DataFrame, dim: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The R11 guard from the segment aggregate itself, per measure: the segments of one
    dimension partition the rows (NULLs are '(unknown)'), so their sums are the period
    totals. Saves a second pass over the fact."""
    t = (seg.filter(F.col("dimension") == dim).groupBy("measure")
            .agg(money(F.sum("prev")).alias("total_prev"), money(F.sum("cur")).alias("total_cur")))
    change = F.when(F.col("total_prev") != 0,
                    F.abs(F.col("total_cur") - F.col("total_prev")) / F.col("total_prev"))
    return t.select("measure", "total_prev", "total_cur", change.alias("total_change"),
                    F.coalesce(change >= rules.min_total_change, F.lit(False)).alias("look_for_drivers"))


def find_drivers(fact: DataFrame, prev: list[str], cur: list[str], dims=DIMENSIONS,
                 measure: str | tuple = "revenue", rules: Rules = DEFAULT_RULES) -> DataFrame:
    """F8 / F9 (R11): one aggregate over the fact feeds the contributions and the guard
    (the plan reuses its exchange); several measures come from the same aggregate, with
    driver_rank counted within each measure."""
    seg = segment_periods(fact, prev, cur, dims, measure)
    return drivers_from(contribution_from(seg), guard_from_segments(seg, dims[0], rules), rules)


# ---------------------------------------------------------------- F11 / F12
def leakage_alert(leak_monthly: DataFrame, history: int = LEAKAGE_HISTORY,
                  sigma: float = LEAKAGE_SIGMA) -> DataFrame:
    """the last month's returned share against mean + sigma * sample sd of the
    `history` months before it. Input: (month, cancelled, returned) per complete month."""
    w = Window.orderBy("month").rowsBetween(-history, -1)
    last = Window.orderBy(F.desc("month"))
    t = leak_monthly.select("month", "returned",
                            F.avg("returned").over(w).alias("hist_mean"),
                            F.stddev_samp("returned").over(w).alias("hist_sd"),
                            F.count("returned").over(w).alias("history"),
                            F.row_number().over(last).alias("rn"))
    sd_units = F.when(F.col("hist_sd") != 0, (F.col("returned") - F.col("hist_mean")) / F.col("hist_sd"))
    return t.filter("rn = 1").select(
        "month", F.col("returned").alias("returned_share"), "hist_mean", "hist_sd", "history",
        sd_units.alias("sd_above"),
        F.coalesce(F.col("returned") > F.col("hist_mean") + sigma * F.col("hist_sd"), F.lit(False)).alias("alert"))


def leave_one_out_median(seg: DataFrame, value: str, key: str = "segment",
                         ratio_flag: float = SEGMENT_RATIO) -> DataFrame:
    """each segment against the median of the OTHER segments, from order statistics
    (no pairs, no per-row arrays): with v sorted and the segment at rank r, the remaining
    m = n-1 values are w_i = v_i (i < r) or v_{i+1} (i >= r), and their median needs w at
    positions floor(m/2) .. floor(m/2)+1, i.e. v at three fixed positions p0, p0+1, p0+2.
    Segment grain: the windows see one row per segment."""
    allv = Window.partitionBy()
    t = seg.select("*", F.row_number().over(Window.orderBy(F.col(value), F.col(key))).alias("_r"),
                   F.count(F.lit(1)).over(allv).alias("_n"))
    m = F.col("_n") - 1
    p0 = F.floor(m / 2).cast("long")
    v = F.col(value).cast("double")
    t = t.withColumn("_p0", p0)
    vp = [F.max(F.when(F.col("_r") == F.col("_p0") + i, v)).over(allv) for i in range(3)]
    t = t.select("*", *[x.alias(f"_v{i}") for i, x in enumerate(vp)])

    def at(j: Column) -> Column:                      # v_j for j in {p0, p0+1, p0+2}
        return (F.when(j == F.col("_p0"), F.col("_v0")).when(j == F.col("_p0") + 1, F.col("_v1"))
                 .when(j == F.col("_p0") + 2, F.col("_v2")))

    def w(i: Column) -> Column:                       # i-th value without the segment itself
        return F.when(i < F.col("_r"), at(i)).otherwise(at(i + 1))

    med = (F.when(m <= 0, F.lit(None).cast("double"))
            .when(m % 2 == 1, w(F.col("_p0") + 1))
            .otherwise((w(F.col("_p0")) + w(F.col("_p0") + 1)) / 2))
    return (t.withColumn("others_median", med)
             .withColumn("flagged", F.coalesce(F.col(value) >= ratio_flag * F.col("others_median"), F.lit(False)))
             .drop("_r", "_n", "_p0", "_v0", "_v1", "_v2"))


def outlier_segments(leak_by_dim: DataFrame, ratio_flag: float = SEGMENT_RATIO) -> DataFrame:
    """F12 on leakage_by_dim output: segments whose returned share >= 2 x the others' median."""
    return leave_one_out_median(leak_by_dim.select("segment", "returned"), "returned", "segment", ratio_flag)
