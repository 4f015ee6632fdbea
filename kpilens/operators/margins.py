"""Margin rules as data (I10, I11): what an edited copy must show, rule by rule, and what it must not.

A planted driver is a row of a table (scenario, dimension, segment, sign of its change, lowest share, lowest lift
gap, worst rank); joining it with the drivers found gives one verdict per rule. Drivers that appear or vanish
without a plant are anti joins both ways. Levels are judged over a frame of months: loud where planted, quiet
in every other segment and month of the history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpilens.config import RETURNED_PLANT_MIN, RETURNED_PLANT_RATIO
from kpilens.functions.columns import ratio

PLANT = ("scenario string, dimension string, segment string, sign int, min_share double, min_gap double, worst_rank int")
HISTORY = 8                                              # months a level is watched for


def driver_verdicts(drivers: DataFrame, plants: DataFrame) -> DataFrame:
    """(scenario, driver, rule, value, ok) for each planted driver; a driver that is not there fails every rule."""
    found = drivers.select("scenario", "dimension", "segment", "delta", "share_of_change", "lift", "is_new_segment", "driver_rank")
    j = plants.join(found, ["scenario", "dimension", "segment"], "left")
    share, gap = F.abs("share_of_change"), F.abs(F.col("lift") - 1)

    def rule(name: str, value: Column, ok: Column) -> Column:
        return F.struct(F.lit(name).alias("rule"), value.cast("double").alias("value"), F.coalesce(ok, F.lit(False)).alias("ok"))
    rules = [rule("present", F.col("delta").isNotNull().cast("int"), F.col("delta").isNotNull()),
             rule("direction", F.signum("delta"), F.signum("delta") == F.col("sign")),
             rule("share", share, share >= F.col("min_share")),
             rule("lift gap", gap, F.col("is_new_segment") | (gap >= F.col("min_gap"))),
             rule("rank", F.col("driver_rank"), F.col("driver_rank") <= F.col("worst_rank"))]
    return j.select("scenario", F.concat("dimension", F.lit("="), "segment").alias("driver"), F.inline(F.array(*rules)))


def nothing_new(base: DataFrame, other: DataFrame, scenario: str) -> DataFrame:
    """Two verdicts: no driver of `other` is missing from `base`, and none of `base` from `other`."""
    def lacking(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
        keys = ["dimension", "segment"]
        n = a.select(*keys).join(b.select(*keys), keys, "left_anti").agg(F.count(F.lit(1)).alias("n"))
        return n.select(F.lit(scenario).alias("scenario"), F.lit("(any)").alias("driver"), F.lit(name).alias("rule"),
                        F.col("n").cast("double").alias("value"), (F.col("n") == 0).alias("ok"))
    return lacking(other, base, "nothing new").unionByName(lacking(base, other, "nothing gone"))


def level_verdicts(cube: DataFrame, dim: str, planted: DataFrame, months: list[str]) -> DataFrame:
    """(month, segment, returned, others_max, loud, expected, ok) from a segment cube: a segment's returned share of revenue
    is loud at 0.30 and 3 x every other segment's; it must be so exactly where planted in `months`."""
    zero = F.lit(0).cast("decimal(38,2)")
    g = (cube.filter(F.col("dimension") == dim).groupBy("month", "segment")
             .agg(ratio(F.sum(F.when(F.col("order_status") == "Returned", F.col("sale_price")).otherwise(zero)), F.sum("sale_price")).alias("returned")))
    per_month = Window.partitionBy("month")                                   # segment grain
    g = g.withColumn("_r", F.row_number().over(per_month.orderBy(F.desc_nulls_last("returned"), "segment")))
    first, second = [F.max(F.when(F.col("_r") == i, F.col("returned"))).over(per_month) for i in (1, 2)]
    g = g.withColumn("others_max", F.when(F.col("_r") == 1, second).otherwise(first)).drop("_r")
    loud = (F.col("returned") >= RETURNED_PLANT_MIN) & F.coalesce(F.col("returned") >= RETURNED_PLANT_RATIO * F.col("others_max"), F.lit(True))
    marked = planted.select("segment").distinct().withColumn("_planted", F.lit(True))
    g = g.withColumn("loud", F.coalesce(loud, F.lit(False))).join(marked, "segment", "left")
    g = g.withColumn("expected", F.coalesce("_planted", F.lit(False)) & F.col("month").isin(*months))
    return g.select("month", "segment", "returned", "others_max", "loud", "expected", (F.col("loud") == F.col("expected")).alias("ok"))
