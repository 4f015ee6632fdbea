"""Hard-negative mining (operator 11) with a GNAT index (`gnat.py`).

An anchor's positives are its `n_positives` best other rows of the same label by inner product; a positive's
hard negatives are the `n_negatives` best rows of other labels whose score lies in a window below the positive's:
`low` * positive <= 100 * negative <= `high` * positive (whole percents). Both are searches in the
index: the first without bounds, the second with one annulus per positive. Results are exact.

Edge cases: rows with a null id, label or vector, or a null or non-finite component take no part; rows
that share an id count once (the one with the smallest label, then vector); ties go to the smaller id; an anchor
without another row of its label, and a positive whose window is empty (such as one of a negative score), give no rows; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpilens.llm import gnat
from kpilens.llm.common import stored

SCALE = 256                        # a component x becomes floor(SCALE * x)
EMPTY = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def usable(rows: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """(id, label, q): the rows that take part, with whole-number vectors."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    d = rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    d = d.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad)
    d = d.select("id", F.struct("label", F.transform("v", lambda x: F.floor(x * SCALE)).alias("q")).alias("r"))
    return d.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.q")


def _floor_div(x: Column, by: int) -> Column:
    """floor(x / by) of a whole-number decimal."""
    return ((x - F.pmod(x, F.lit(by))) / by).cast("decimal(38,0)")


def mine(rows: DataFrame, anchor: Column, low: int = 30, high: int = 90, n_positives: int = 5, n_negatives: int = 10) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows (id, label, q) where `anchor` holds."""
    rows = stored(rows, "vectors")
    index = gnat.build(rows)
    if index is None:
        return rows.sparkSession.createDataFrame([], EMPTY)
    dim = index.tree.dim
    full = F.concat("q", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("q")))
    anchors = rows.where(anchor).select("id", "label", full.alias("q"))
    most = (1 << 62)
    free = anchors.withColumns({"lo": F.array(F.lit(-most)), "hi": F.array(F.lit(most))})
    positives = stored(gnat.ranked(index.search(free, n_positives, True, 1), free, n_positives).drop("window"), "positives")

    p = F.col("score").cast("decimal(20,0)")               # a score may be close to the largest long
    spans = F.struct((F.col("rank") - 1).alias("window"), (-_floor_div(-low * p, 100)).cast("long").alias("lo"), _floor_div(high * p, 100).cast("long").alias("hi"))
    per = positives.groupBy(F.col("query").alias("id")).agg(F.sort_array(F.collect_list(spans)).alias("w"))
    def padded(c, fill):
        return F.transform(F.sequence(F.lit(0), F.lit(n_positives - 1)), lambda i: F.coalesce(F.get(F.col("w"), i)[c], F.lit(fill).cast("long")))
    asked = stored(anchors.join(per, "id").select("id", "label", "q", padded("lo", 1).alias("lo"), padded("hi", 0).alias("hi")), "windows")
    found = gnat.ranked(index.search(asked, n_negatives, False, n_positives), asked, n_negatives)
    pos = positives.select(F.col("query").alias("anchor_id"), (F.col("rank") - 1).alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    neg = found.select(F.col("query").alias("anchor_id"), "window", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pos.join(neg, ["anchor_id", "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
