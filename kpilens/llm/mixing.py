"""Mixing sources to target weights by temperature (operator 1).

The weight of source i is s_i^a / sum_j s_j^a, where s is its share of all tokens. The exponent a
in [0, 1] is bisected until the weights' entropy meets `target_entropy` (nats) or no source is
read more than `max_repeat` times; of both, the larger exponent holds. One aggregate over the
source totals evaluates 31 exponents, which is five bisections, so no per-source table reaches
the driver however many sources there are.

The weights become token budgets: of a total `budget`, or, if none is given, of the smallest
total that reads the least repeated source once and so drops no document. Each source is cut
into hash blocks of about `block_tokens` tokens. Whole epochs emit every block in a permutation
of their own; the last epoch emits blocks in its permutation until the budget is used, and the
block at the edge document by document (the first one that would pass the budget ends it).

Edge cases: a null source is a source of its own; a source without any token is read once; null
and empty texts have 0 tokens and follow their block; repeated rows are emitted each; an empty
table gives an empty result; input columns of any name come back as they were (inside, they have names of their
own); if one is called `mix`, the plan's struct is called `mix_` (and so on until the name is free).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from kpilens.llm.common import stored, word_count

SEED = 17
POINTS = 31
PASSES = 7
BROADCAST_BLOCKS = 50_000          # the block plan is broadcast up to here, else joined by shuffle


def source_totals(rows: DataFrame) -> DataFrame:
    """(source, tokens, share) of (source, n_tokens)."""
    totals = stored(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens")), "totals")
    whole = totals.agg(F.sum("tokens").alias("w")).first()["w"] or 0
    share = F.col("tokens") / F.lit(float(whole)) if whole else F.lit(0.0)
    return totals.withColumn("share", share.cast("double"))


def _bisect(totals: DataFrame, score, wanted: float) -> float:
    """Smallest exponent in [0, 1] whose score is <= wanted (the score falls as the exponent grows); 1 if none."""
    lo, hi = 0.0, 1.0
    live = totals.where("share > 0")
    sh, x = F.col("share"), F.col("x")
    for _ in range(PASSES):
        step = (hi - lo) / (POINTS + 1)
        xs = [lo + step * i for i in range(POINTS + 2)]
        got = (live.withColumn("x", F.explode(F.array(*[F.lit(v) for v in xs]))).groupBy("x").agg(
            F.sum(F.pow(sh, x)).alias("z"), F.sum(F.pow(sh, x) * F.log(sh)).alias("e"),
            F.max(F.pow(sh, x - 1)).alias("big"), F.min(F.pow(sh, x - 1)).alias("least")).collect())
        below = [r["x"] for r in got if score(r) <= wanted]
        if not below:
            return 1.0
        hi = min(below)
        if hi == lo:
            return lo
        lo = max(v for v in xs if v < hi)
    return hi


def _entropy(r) -> float:
    return math.log(r["z"]) - r["x"] * r["e"] / r["z"]


def temperature(totals: DataFrame, target_entropy: float | None = None, max_repeat: float | None = None,
                budget: int | None = None) -> float:
    """The exponent that meets the target entropy and the repetition limit."""
    if totals.where("share > 0").isEmpty():
        return 1.0
    whole = totals.agg(F.sum("tokens")).first()[0]
    out = 0.0 if target_entropy is None and max_repeat is not None else (1.0 if target_entropy is None else 0.0)
    if target_entropy is not None:
        out = max(out, _bisect(totals, _entropy, target_entropy))
    if max_repeat is not None:
        def repeats(r):
            return r["big"] / r["least"] if budget is None else budget / whole * r["big"] / r["z"]
        out = max(out, _bisect(totals, repeats, max_repeat))
    return out


def source_budgets(totals: DataFrame, exponent: float, budget: int | None = None, block_tokens: int = 1 << 18) -> DataFrame:
    """(source, tokens, weight, full epochs, tokens of the last epoch, blocks)."""
    p = F.pow(F.col("share"), F.lit(exponent))
    z = totals.where("share > 0").agg(F.sum(p).alias("z"), F.max(F.col("tokens") / p).alias("once")).first()
    norm = z["z"] or 1.0
    total = float(budget) if budget is not None else (z["once"] or 0.0) * norm
    weight = F.when(F.col("share") > 0, p / F.lit(norm)).otherwise(F.lit(0.0))
    own = F.round(weight * F.lit(total)).cast("long")
    full = F.when(F.col("tokens") > 0, F.floor(own / F.col("tokens"))).otherwise(F.lit(1)).cast("int")
    rest = F.when(F.col("tokens") > 0, own - F.col("full") * F.col("tokens")).otherwise(F.lit(0)).cast("long")
    return (totals.withColumn("weight", weight).withColumn("full", full).withColumn("rest", rest)
            .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(block_tokens))).cast("int")))


def _hash(*cols: Column) -> Column:
    """A 60-bit number from the MD5 of the text of the columns (any engine can repeat it)."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])), 1, 15), 16, 10).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        target_entropy: float | None = None, max_repeat: float | None = 2.0, budget: int | None = None,
        block_tokens: int = 1 << 18) -> DataFrame:
    """Rows of `docs` as often as their source's budget reads them, plus `mix`, a struct of
    (n_tokens, weight, epoch, block_rank, order_key): sort by these three to read the mixture."""
    given = {c: f"__in{i}" for i, c in enumerate(docs.columns)}
    plan_col = "mix"
    while plan_col in given:
        plan_col += "_"
    id_col, text_col, source_col = given[id_col], given[text_col], given[source_col]
    d = docs.toDF(*given.values()).withColumn("__n", word_count(F.col(text_col)))
    light = stored(d.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"), F.col("__n").alias("n_tokens")), "tokens")
    totals = source_totals(light)
    exponent = temperature(totals, target_entropy, max_repeat, budget)
    plan = stored(source_budgets(totals, exponent, budget, block_tokens), "budgets")
    block = F.pmod(_hash(F.lit(SEED), F.col("id")), F.col("blocks")).cast("int")
    small = _same_source(light, plan).withColumn("block", block)
    sizes = stored(small.groupBy("source", "block").agg(F.sum("n_tokens").alias("block_tokens"),
                                                        F.first("weight").alias("weight"), F.first("full").alias("full"),
                                                        F.first("rest").alias("rest"), F.first("blocks").alias("blocks")), "blocks")
    turns = sizes.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("full"))))
    order = Window.partitionBy("source", "epoch").orderBy(_hash(F.lit(SEED), F.col("epoch"), F.col("source"), F.col("block")), "block")
    turns = (turns.withColumn("block_rank", F.row_number().over(order))
             .withColumn("before", F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))))
    before = F.coalesce("before", F.lit(0))
    turns = (turns.withColumn("room", F.when(F.col("epoch") < F.col("full"), F.lit(None).cast("long")).otherwise(F.col("rest") - before))
             .where(F.col("room").isNull() | (F.col("room") > 0))
             .withColumn("edge", F.col("room").isNotNull() & (F.col("room") < F.col("block_tokens")))
             .select("source", "block", "weight", "epoch", "block_rank", "room", "edge"))
    turns = stored(turns, "turns")
    # the block at a budget's edge: documents in key order while they fit (rows of one id go together)
    edges = turns.where("edge").select(F.col("source").alias("__s"), F.col("block").alias("__b"), "epoch", "room")
    in_edge = small.join(edges, small["source"].eqNullSafe(edges["__s"]) & (F.col("block") == F.col("__b")))
    up_to = Window.partitionBy("__s", "__b").orderBy("__key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    limits = (in_edge.withColumn("__key", _hash(F.lit(SEED), F.col("epoch"), F.col("id")))
              .withColumn("__sum", F.sum("n_tokens").over(up_to)).where(F.col("__sum") <= F.col("room"))
              .groupBy("__s", "__b").agg(F.max("__key").alias("limit")))
    turns = turns.join(limits, turns["source"].eqNullSafe(limits["__s"]) & (F.col("block") == F.col("__b")), "left").select(
        F.col("source").alias("__s"), F.col("block").alias("__b"), "weight", "epoch", "block_rank",
        F.when(~F.col("edge"), F.lit((1 << 60) - 1)).otherwise(F.coalesce("limit", F.lit(-1))).alias("limit"))
    turns = stored(turns, "turns")
    few = F.broadcast(turns) if turns.count() <= BROADCAST_BLOCKS else turns
    heads = plan.select(F.col("source").alias("__p"), F.col("blocks").alias("__blocks"))
    heads = F.broadcast(heads) if heads.count() <= BROADCAST_BLOCKS else heads
    d = d.join(heads, d[source_col].eqNullSafe(heads["__p"])).withColumn(
        "__blk", F.pmod(_hash(F.lit(SEED), F.col(id_col)), F.col("__blocks")).cast("int"))
    out = d.join(few, d[source_col].eqNullSafe(few["__s"]) & (F.col("__blk") == F.col("__b")))
    out = out.withColumn("__key", _hash(F.lit(SEED), F.col("epoch"), F.col(id_col)))
    rows = out.where(F.col("__key") <= F.col("limit"))
    mixed = F.struct(F.col("__n").alias("n_tokens"), F.col("weight"), F.col("epoch"), F.col("block_rank"), F.col("__key").alias("order_key"))
    return rows.select(*[F.col(inner).alias(c) for c, inner in given.items()], mixed.alias(plan_col))


def _same_source(rows: DataFrame, plan: DataFrame) -> DataFrame:
    p = plan.select(F.col("source").alias("__p"), "weight", "full", "rest", "blocks")
    p = F.broadcast(p) if p.count() <= BROADCAST_BLOCKS else p
    return rows.join(p, rows["source"].eqNullSafe(p["__p"])).drop("__p")
