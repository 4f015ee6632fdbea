"""F13 change report and F14 truth document: compositions of the operators.

Both are one-row DataFrames assembled from one-row frames with cross products
(every input is already aggregated to a single row or to segment grain). Everything
but the two item-level traps is read from the stored segment cube.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kpilens.config import DIMENSIONS
from kpilens.operators import cube as C
from kpilens.operators import explain as X
from kpilens.operators import funnel as G
from kpilens.operators import metrics as E
from kpilens.plans.registry import kpi, periods
from kpilens.session import ensure_checkpoint_dir


def _driver_text(df: DataFrame, group: int, order_col: str, measure: str | None = None) -> DataFrame:
    m = F.lit(measure) if measure else F.col("measure")
    return df.select(F.lit(group).alias("g"), F.col(order_col).alias("o"),
                     F.concat(F.col("dimension"), F.lit("="), F.col("segment"), F.lit(" ("), m, F.lit(")"))
                      .alias("txt"))


def _agg_text(rows: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("g", "o", "txt")))
    return rows.agg(F.count(F.lit(1)).alias("n_drivers"),
                    F.concat_ws("|", F.transform(ordered, lambda x: x["txt"])).alias("drivers"))


def change_report(spark: SparkSession, sf_dir: str, thorough: bool = False) -> DataFrame:
    """"why did revenue change last month?" walked down the metric tree.
    naive: revenue -> unusual? -> gross drivers; thorough: + net drivers, returned share
    against its own 12-month history, and returned share by centre when it alerts."""
    k, p = kpi(spark, sf_dir), periods(spark, sf_dir)
    last, prev = p["last_month"], p["previous_month"]
    d = X.decompose(k.monthly, prev, last)
    z = X.zscore_window(k.monthly, last, last[0]).select("zscore", "unusual")
    head = d.crossJoin(z).select(
        F.lit(last[0]).alias("period"), F.lit(prev[0]).alias("previous"), F.lit("revenue").alias("measure"),
        F.col("revenue_cur").alias("value"), F.col("revenue_prev").alias("value_previous"),
        F.col("delta_pct").alias("change_pct"), "zscore", "unusual", "volume_share", "aov_share")
    if not thorough:
        rows = _driver_text(C.find_drivers(k.cube, prev, last, DIMENSIONS, "revenue"), 0, "driver_rank")
        return head.crossJoin(_agg_text(rows))
    both = C.find_drivers(k.cube, prev, last, DIMENSIONS, ("revenue", "net_revenue"))     # one pass, two measures
    rows = _driver_text(both.withColumn("driver_rank", F.col("driver_rank")
                                        + F.when(F.col("measure") == "net_revenue", F.lit(1_000_000_000))
                                           .otherwise(F.lit(0))), 0, "driver_rank")
    alert = X.leakage_alert(k.leakage_monthly()).select(
        F.col("returned_share"), F.col("hist_mean").alias("returned_hist_mean"),
        F.col("hist_sd").alias("returned_hist_sd"), F.col("alert").alias("returned_alert"))
    by = C.leakage_by_dim(k.cube, last[0], "dist_center")
    order = F.row_number().over(Window.orderBy(F.desc("revenue"), "segment"))
    out = (X.outlier_segments(by).join(by.select("segment", "revenue"), "segment")
            .withColumn("o", order).crossJoin(alert.select("returned_alert"))
            .filter(F.col("flagged") & F.col("returned_alert"))
            .select(F.lit("dist_center").alias("dimension"), "segment", "o"))
    rows = rows.unionByName(_driver_text(out, 2, "o", "returned_share"))
    return head.crossJoin(alert).crossJoin(_agg_text(rows))


def truth_document(spark: SparkSession, sf_dir: str, planted: list | None = None) -> DataFrame:
    """F14 (A9): the frozen-truth document of one data set, as one JSON string.
    Rounding per field: money 2, shares 4, lift 3, z 2 digits."""
    k, p = kpi(spark, sf_dir), periods(spark, sf_dir)
    last, prev1, last3, prev3 = p["last_month"], p["previous_month"], p["last_3_months"], p["previous_3_months"]
    r = F.round

    def headline(months):
        t = E.period_totals(k.monthly, months)
        return t.select(F.struct(F.split(F.col("months"), ",").alias("months"), "revenue", "net_revenue",
                                 "orders", "items", "profit", "aov", "margin").alias("headline"))

    def decomp(a, b, name):
        d = X.decompose(k.monthly, a, b)
        return d.select(F.struct(F.split("prev", ",").alias("prev"), F.split("cur", ",").alias("cur"),
                                 r("revenue_prev", 2).alias("revenue_prev"), r("revenue_cur", 2).alias("revenue_cur"),
                                 r("delta", 2).alias("delta"), r("delta_pct", 4).alias("delta_pct"),
                                 r("volume_effect", 2).alias("volume_effect"), r("aov_effect", 2).alias("aov_effect"),
                                 r("volume_share", 4).alias("volume_share"),
                                 r("aov_share", 4).alias("aov_share")).alias(name))

    def drivers(a, b, name):
        dr = C.find_drivers(k.cube, a, b, DIMENSIONS, ("revenue", "net_revenue"))
        s = F.struct("driver_rank", "dimension", "segment", "measure", "delta", "share_of_change",
                     "share_of_base", "lift", "is_new_segment")
        gross = F.array_sort(F.collect_list(F.when(F.col("measure") == "revenue", s)))
        net = F.array_sort(F.collect_list(F.when(F.col("measure") == "net_revenue", s)))
        return dr.agg(gross.alias(name), net.alias("net_" + name))

    def top5(a, b, name):
        c = X.contribution_top(C.contribution_all(k.cube, a, b), 5)
        s = F.struct("dimension", "rank", "segment", r("delta", 2).alias("delta"),
                     r("share_of_change", 4).alias("share_of_change"),
                     r("share_of_base", 4).alias("share_of_base"), r("lift", 3).alias("lift"))
        return c.agg(F.array_sort(F.collect_list(s)).alias(name))

    monthly = (k.monthly_with_leakage().orderBy(F.desc("month")).limit(12)
               .agg(F.array_sort(F.collect_list(F.struct(
                   "month", r("revenue", 2).alias("revenue"), r("net_revenue", 2).alias("net_revenue"), "orders",
                   "items", r("aov", 2).alias("aov"), r("margin", 4).alias("margin"), r("mom", 4).alias("mom"),
                   r("cancelled", 4).alias("cancelled_share"), r("returned", 4).alias("returned_share"))))
                   .alias("monthly")))
    z1 = X.zscore_window(k.monthly, last, last[0]).select(r("zscore", 2).alias("zscore"), "unusual")
    z3 = X.zscore_window(k.monthly, last3, last3[0]).agg(
        F.array_sort(F.collect_list(F.struct("month", r("zscore", 2).alias("zscore")))).alias("zscore_by_month"),
        F.array_sort(F.collect_list(F.when(F.col("unusual"), F.col("month")))).alias("unusual_months"))
    leak = C.leakage(k.cube, last[0]).select(F.struct(r("cancelled", 4).alias("cancelled"),
                                                      r("returned", 4).alias("returned")).alias("leakage"))
    by_dc = C.leakage_by_dim(k.cube, last[0], "dist_center").agg(F.array_sort(F.collect_list(F.struct(
        "segment", r("revenue", 2).alias("revenue"), r("cancelled", 4).alias("cancelled"),
        r("returned", 4).alias("returned")))).alias("leakage_by_dist_center"))
    funnel_src = None
    if k.session_periods():
        sp = k.session_periods()[-1]
        funnel_src = G.funnel(k.sessions, sp, "traffic_source").agg(F.array_sort(F.collect_list(F.struct(
            "segment", "sessions", r("purchase_rate", 4).alias("purchase_rate")))).alias("funnel_by_session_source"))
    wrong = (E.trap_item_month(k.star, last[0]).select(r("revenue", 2).alias("revenue_last_month_by_item_month"))
             .crossJoin(k.monthly.filter(F.col("month") == last[0])
                        .select(r("net_revenue", 2).alias("revenue_last_month_net_instead_of_gross")))
             .crossJoin(E.trap_fanout(k.star, last[0]).select(r("revenue", 2).alias("revenue_last_month_fanout")))
             .crossJoin(k.monthly.filter(F.col("month").isin(last3))
                        .agg(r(F.avg("aov"), 2).alias("aov_last_3_months_as_mean_of_monthly"))))
    lm = (headline(last).crossJoin(decomp(prev1, last, "vs_previous_month")).crossJoin(z1)
          .crossJoin(drivers(prev1, last, "drivers"))
          .crossJoin(top5(prev1, last, "contribution_top5")).crossJoin(leak).crossJoin(by_dc))
    if funnel_src is not None:
        lm = lm.crossJoin(funnel_src)
    l3 = (headline(last3).crossJoin(decomp(prev3, last3, "vs_previous_3_months")).crossJoin(z3)
          .crossJoin(drivers(prev3, last3, "drivers"))
          .crossJoin(top5(prev3, last3, "contribution_top5")))
    meta = F.struct(F.lit(k.rules.today).alias("today"),
                    F.struct(F.lit(k.rules.unusual_z).alias("unusual_z"),
                             F.lit(k.rules.lookback).alias("zscore_lookback"),
                             F.lit(k.rules.min_share).alias("driver_min_share"),
                             F.lit(k.rules.min_lift_gap).alias("driver_min_lift_gap"),
                             F.lit(k.rules.min_total_change).alias("min_total_change")).alias("thresholds"))
    defaults = F.struct(F.lit(last[0]).alias("last_month"), F.lit(prev1[0]).alias("previous_month"),
                        F.array(*[F.lit(m) for m in last3]).alias("last_3_months"),
                        F.array(*[F.lit(m) for m in prev3]).alias("previous_3_months"))
    lm_s = lm.select(F.struct(F.lit(last[0]).alias("period"), *lm.columns).alias("last_month"))
    l3_s = l3.select(F.struct(F.array(*[F.lit(m) for m in last3]).alias("period"), *l3.columns).alias("last_3_months"))
    wrong_s = wrong.select(F.struct(*wrong.columns).alias("known_wrong_answers"))
    doc = (monthly.crossJoin(lm_s).crossJoin(l3_s).crossJoin(wrong_s)
           .select(F.struct(meta.alias("_meta"),
                            F.array(*[F.lit(x) for x in (planted or [])]).cast("array<string>").alias("planted"),
                            defaults.alias("defaults"), "monthly", "last_month", "last_3_months",
                            "known_wrong_answers").alias("doc")))
    return doc.select(F.lit(last[0]).alias("last_month"), F.to_json("doc").alias("truth_json"))


_DRIVERS = ("array<struct<driver_rank: bigint, dimension: string, segment: string, measure: string, delta: double, "
            "share_of_change: double, share_of_base: double, lift: double, is_new_segment: boolean>>")
_TOP = ("array<struct<dimension: string, rank: bigint, segment: string, delta: double, share_of_change: double, "
        "share_of_base: double, lift: double>>")
_HEADLINE = ("headline: struct<months: array<string>, revenue: double, net_revenue: double, orders: bigint, items: bigint, "
             "profit: double, aov: double, margin: double>")
_CHANGE = ("struct<prev: array<string>, cur: array<string>, revenue_prev: double, revenue_cur: double, delta: double, "
           "delta_pct: double, volume_effect: double, aov_effect: double, volume_share: double, aov_share: double>")
#: The truth document's fields, so that reading it back needs no inference pass.
TRUTH_SCHEMA = (
    "_meta struct<today: string, thresholds: struct<unusual_z: double, zscore_lookback: bigint, driver_min_share: double, "
    "driver_min_lift_gap: double, min_total_change: double>>, planted array<string>, "
    "defaults struct<last_month: string, previous_month: string, last_3_months: array<string>, previous_3_months: array<string>>, "
    "monthly array<struct<month: string, revenue: double, net_revenue: double, orders: bigint, items: bigint, aov: double, "
    "margin: double, mom: double, cancelled_share: double, returned_share: double>>, "
    f"last_month struct<period: string, {_HEADLINE}, vs_previous_month: {_CHANGE}, zscore: double, unusual: boolean, "
    f"drivers: {_DRIVERS}, net_drivers: {_DRIVERS}, contribution_top5: {_TOP}, leakage: struct<cancelled: double, returned: double>, "
    "leakage_by_dist_center: array<struct<segment: string, revenue: double, cancelled: double, returned: double>>, "
    "funnel_by_session_source: array<struct<segment: string, sessions: bigint, purchase_rate: double>>>, "
    f"last_3_months struct<period: array<string>, {_HEADLINE}, vs_previous_3_months: {_CHANGE}, "
    "zscore_by_month: array<struct<month: string, zscore: double>>, unusual_months: array<string>, "
    f"drivers: {_DRIVERS}, net_drivers: {_DRIVERS}, contribution_top5: {_TOP}>, "
    "known_wrong_answers struct<revenue_last_month_by_item_month: double, revenue_last_month_net_instead_of_gross: double, "
    "revenue_last_month_fanout: double, aov_last_3_months_as_mean_of_monthly: double>")


def read_truth_document(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A10: read a frozen truth document back (one JSON document per file, explicit schema:
    no inference pass over the data)."""
    r = spark.read.option("multiLine", True)
    return r.schema(schema).json(path) if schema else r.json(path)


def write_truth_document(doc: DataFrame, path: str) -> None:
    """The document column as text files, one JSON document per line (coalesced to
    one file: the document is one row)."""
    doc.select("truth_json").coalesce(1).write.mode("overwrite").text(path)


_FROZEN: dict[tuple[str, str], str] = {}


def frozen_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The directory's truth document as a source: computed and written once per application (shared folder),
    read back with its schema. Whoever grades answers reads this, and computes nothing anew."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _FROZEN:
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kpilens-truth-{uuid.uuid4().hex}"
        write_truth_document(truth_document(spark, sf_dir), path)
        _FROZEN[key] = path
    return read_truth_document(spark, _FROZEN[key], TRUTH_SCHEMA)
