"""Data contracts. Each check is a DataFrame of rows with an `ok` column,
so a pipeline can assert `df.filter(~ok).count() == 0` or publish the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpilens.config import DIMENSIONS, RETURNED_PLANT_MIN, RETURNED_PLANT_RATIO
from kpilens.functions.columns import fact_months, money, ratio


def close(a: Column, b: Column, rel: float = 1e-9, abs_tol: float = 1e-6) -> Column:
    """math.isclose for columns; NULL on either side is not close."""
    tol = F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(abs_tol))
    return F.coalesce(F.abs(a - b) <= tol, F.lit(False))


def long_form(df: DataFrame, keys: list[str], measures: list[str], value: str = "value") -> DataFrame:
    st = F.inline(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias(value))
                            for m in measures]))
    return df.select(*keys, st)


def compare(a: DataFrame, b: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """Full outer join of two (keys..., value) frames with a tolerance verdict."""
    j = a.withColumnRenamed("value", left).join(b.withColumnRenamed("value", right), keys, "full")
    return j.withColumn("ok", close(F.col(left), F.col(right)))


def recon_monthly(monthly: DataFrame, monthly_sql: DataFrame) -> DataFrame:
    """The DataFrame path and the SQL path agree month by month (complete months)."""
    cols = ["revenue", "net_revenue", "orders", "items", "profit"]
    a = long_form(monthly, ["month"], cols)
    b = long_form(monthly_sql.join(monthly.select("month"), "month", "left_semi"), ["month"], cols)
    return compare(a, b, ["month", "measure"], "fact_value", "sql_value")


def segment_revenue(fact: DataFrame, months: list[str], dims) -> DataFrame:
    """(dimension, month, segment, value) revenue from the fact for several dimensions."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("segment")) for d in dims])
    return (fact.filter(fact_months(months))
                .select("month", F.inline(pairs), "sale_price")
                .groupBy("dimension", "month", "segment").agg(money(F.sum("sale_price")).alias("value")))


def segments_sum(cube: DataFrame, monthly: DataFrame, months: list[str], dims=DIMENSIONS) -> DataFrame:
    """I4: per dimension and month the segments of the cube add up to the month's revenue."""
    rows = cube.filter(F.col("month").isin(*months) & F.col("dimension").isin(*dims))
    seg = rows.groupBy("dimension", "month").agg(money(F.sum("sale_price")).alias("segments_total"))
    return (seg.join(monthly.select("month", "revenue"), "month")
               .withColumn("ok", close(F.col("segments_total"), F.col("revenue"))))


def identity_rows(rows: list[tuple[str, Column, Column]], source: DataFrame, negate: bool = False) -> DataFrame:
    """Rows (name, lhs, rhs, ok) from expressions over a one-row `source`."""
    st = F.inline(F.array(*[F.struct(F.lit(n).alias("name"), l.cast("double").alias("lhs"),
                                     r.cast("double").alias("rhs")) for n, l, r in rows]))
    out = source.select(st)
    ok = close(F.col("lhs"), F.col("rhs"))
    return out.withColumn("ok", ~close(F.col("lhs"), F.col("rhs"), rel=1e-6) if negate else ok)


def vocabulary_diff(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """I8 (R14): values of two vocabularies side by side."""
    x = a.select(F.col(a_col).alias("value")).distinct().withColumn("in_acquisition", F.lit(True))
    y = b.select(F.col(b_col).alias("value")).distinct().withColumn("in_session", F.lit(True))
    return (x.join(y, "value", "full")
             .select("value", F.coalesce("in_acquisition", F.lit(False)).alias("in_acquisition"),
                     F.coalesce("in_session", F.lit(False)).alias("in_session")))


def driver_diff(base: DataFrame, scen: DataFrame) -> DataFrame:
    """Drivers of two data sets compared (left_anti both ways shows in one full join)."""
    b = base.select("dimension", "segment", F.lit(True).alias("in_base"))
    s = scen.select("dimension", "segment", F.lit(True).alias("in_scenario"),
                    F.col("driver_rank").alias("scenario_rank"), F.col("share_of_change").alias("scenario_share"),
                    F.col("lift").alias("scenario_lift"))
    return (b.join(s, ["dimension", "segment"], "full")
             .select("dimension", "segment", F.coalesce("in_base", F.lit(False)).alias("in_base"),
                     F.coalesce("in_scenario", F.lit(False)).alias("in_scenario"),
                     "scenario_rank", "scenario_share", "scenario_lift"))


def level_margin(fact: DataFrame, months: list[str], segment: DataFrame, dim: str = "dist_center") -> DataFrame:
    """The planted segment's returned share of revenue is >= 0.30 and >= 3 x every other
    segment's, in each planted month. `segment` is a one-row frame holding the segment."""
    g = (fact.filter(fact_months(months))
             .groupBy("month", F.col(dim).alias("segment"))
             .agg(ratio(F.sum(F.when(F.col("order_status") == "Returned", F.col("sale_price"))
                              .otherwise(F.lit(0).cast("decimal(18,2)"))), F.sum("sale_price")).alias("returned")))
    seg = segment.select(F.col("segment").alias("_planted"), F.lit(True).alias("_is_planted"))
    j = g.join(F.broadcast(seg), g["segment"] == seg["_planted"], "left")       # seg: one row
    planted = j.filter(F.col("_is_planted")).select("month", "segment", "returned")
    others = j.filter(F.col("_is_planted").isNull()).groupBy("month").agg(F.max("returned").alias("others_max"))
    return (planted.join(others, "month", "left")
                   .withColumn("ok", F.coalesce((F.col("returned") >= RETURNED_PLANT_MIN)
                                                & (F.col("returned") >= RETURNED_PLANT_RATIO * F.col("others_max")),
                                                F.lit(False))))
