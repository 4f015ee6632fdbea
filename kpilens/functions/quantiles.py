"""Exact quantiles (linear interpolation, as pandas / SQL `quantile_cont`) and exact rank
selection, without collecting a group's values in one task.

`percentile` keeps every value of a group in one aggregation buffer, and a global quantile is one
group: at scale that is the whole column in one task. Here a column becomes (value, count) cells by
one partial aggregate; the cells are sorted by range once and stored under the shared folder, each with
the number of its range, and every later step reads the stored cells:
  1. exact counts per (group, range), one row each; their running sum locates the range that holds
     each wanted rank.
  2. a cumulative count inside those ranges alone gives the value at the rank.
Ranges are as many as `spark.sql.shuffle.partitions` and cut by sampled cells, so a task holds a share of the
distinct values whatever their spread; a hot value is one cell, and a hot group is many ranges.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpilens.session import ensure_checkpoint_dir


def _values(df: DataFrame, value: str | Column, by: list[str]) -> DataFrame:
    v = (value if isinstance(value, Column) else F.col(value)).cast("double")
    return df.select(*by, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))


def _cells(df: DataFrame, value: str | Column, by: list[str]) -> DataFrame:
    """Stored rows (by..., _v, _c, _p): each distinct value with its count and the number of its range, in order."""
    spark = df.sparkSession
    cells = _values(df, value, by).groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = cells.repartitionByRange(ranges, *by, "_v").withColumn("_p", F.spark_partition_id())
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kpilens-cells-{uuid.uuid4().hex}"
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def _ranks_in_cells(cells: DataFrame, ranks: DataFrame, by: list[str]) -> DataFrame:
    """The cells at 0-based `_k` of each group, for the (by..., _k) rows of `ranks`."""
    sizes = cells.groupBy(*by, "_p").agg(F.sum("_c").alias("_n"))
    w = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)     # a row per range
    sizes = sizes.withColumn("_end", F.sum("_n").over(w)).withColumn("_start", F.col("_end") - F.col("_n"))
    wanted = ranks.select(*by, "_k").distinct()
    wanted = wanted.join(sizes, by) if by else wanted.crossJoin(sizes)                      # no group: a row per range
    wanted = wanted.where((F.col("_start") <= F.col("_k")) & (F.col("_k") < F.col("_end"))).select(*by, "_p", "_k", "_start")
    keys = [*by, "_p"]
    w = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)   # one range of a group
    hit = cells.join(wanted.select(*keys).distinct(), keys, "left_semi").withColumn("_upto", F.sum("_c").over(w))
    k = F.col("_k") - F.col("_start")
    return (hit.join(wanted, keys).where((F.col("_upto") - F.col("_c") <= k) & (k < F.col("_upto")))
            .select(*by, "_k", "_v"))


def values_at_ranks(df: DataFrame, value: str | Column, ranks: DataFrame, by: list[str] | tuple = ()) -> DataFrame:
    """Rows (by..., _k, _v): the value at 0-based rank _k (ascending) of `value` within
    each group, for the (by..., _k) rows of `ranks`. Ranks outside [0, n) give no row."""
    by = list(by)
    return _ranks_in_cells(_cells(df, value, by), ranks, by)


def exact_quantiles(df: DataFrame, value: str | Column, probs: list[float], by: list[str] | tuple = ()) -> DataFrame:
    """Rows (by..., p, q): the exact linear-interpolation quantile q of `value` for each p."""
    by = list(by)
    cells = _cells(df, value, by)
    counts = cells.groupBy(*by).agg(F.sum("_c").alias("_n")).where(F.col("_n") > 0)
    pexpr = F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("p")
    targets = counts.select(*by, "_n", pexpr) \
        .withColumn("_pos", F.col("p") * (F.col("_n") - 1)) \
        .withColumn("_klo", F.floor("_pos").cast("long")) \
        .withColumn("_khi", F.ceil("_pos").cast("long")) \
        .withColumn("_frac", F.col("_pos") - F.col("_klo"))
    ranks = targets.select(*by, F.explode(F.array("_klo", "_khi")).alias("_k"))
    at = _ranks_in_cells(cells, ranks, by)
    lo = at.select(*by, F.col("_k").alias("_klo"), F.col("_v").alias("_vlo"))
    hi = at.select(*by, F.col("_k").alias("_khi"), F.col("_v").alias("_vhi"))
    out = targets.join(lo, by + ["_klo"]).join(hi, by + ["_khi"])
    return out.select(*by, "p", (F.col("_vlo") + F.col("_frac") * (F.col("_vhi") - F.col("_vlo"))).alias("q"))


def quantile_columns(df: DataFrame, value: str | Column, probs: dict[str, float], by: list[str] | tuple = ()) -> DataFrame:
    """exact_quantiles pivoted to one column per named probability."""
    q = exact_quantiles(df, value, list(probs.values()), by)
    by = list(by)
    aggs = [F.max(F.when(F.col("p") == float(p), F.col("q"))).alias(name) for name, p in probs.items()]
    return q.groupBy(*by).agg(*aggs)
