"""A constraint suite: row rules as data, compiled into one aggregate per table.

A rule is a name and a SQL predicate over one table's columns. A row violates a rule if the predicate is false;
a predicate that is NULL (a missing value) passes, as a CHECK constraint would, so "not missing" is a rule of its
own. `compile_rules` turns a table's rules into one `agg` with a conditional count each: the table is
scanned once however many rules there are, with map-side partial counts and only the columns the rules name.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    table: str
    name: str
    holds: str                                           # SQL predicate


def required(schema: T.StructType, table: str, columns: list[str] | None = None) -> list[Rule]:
    """One "not missing" rule for each column (default: all)."""
    return [Rule(table, f"{c} is there", f"`{c}` IS NOT NULL") for c in (columns or schema.fieldNames())]


def compile_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(table_name, rule, checked, violations) of one table's rules, from one aggregate."""
    broken = [F.count_if(~F.coalesce(F.expr(r.holds), F.lit(True))).alias(f"r{i}") for i, r in enumerate(rules)]
    rows = F.inline(F.array(*[F.struct(F.lit(r.table).alias("table_name"), F.lit(r.name).alias("rule"), F.col("n").alias("checked"),
                                       F.col(f"r{i}").alias("violations")) for i, r in enumerate(rules)]))
    return df.agg(F.count(F.lit(1)).alias("n"), *broken).select(rows)


def check(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Every rule with its violations and verdict; a rule about an unknown table is an error."""
    unknown = {r.table for r in rules} - set(tables)
    if unknown:
        raise ValueError(f"rules about unknown tables {sorted(unknown)}; there are {sorted(tables)}")
    parts = [compile_rules(tables[t], [r for r in rules if r.table == t]) for t in dict.fromkeys(r.table for r in rules)]
    return reduce(DataFrame.unionByName, parts).withColumn("ok", F.col("violations") == 0)


def rows_that_break(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The offending rows themselves, with the names of the rules they break."""
    names = F.filter(F.array(*[F.when(~F.coalesce(F.expr(r.holds), F.lit(True)), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    return df.withColumn("broken_rules", names).filter(F.size("broken_rules") > 0)


# ---------------------------------------------------------------- relations between tables
def agreement(child: DataFrame, parent: DataFrame, key: str, pairs: dict[str, tuple[str, str, bool]]) -> DataFrame:
    """(rule, checked, violations, ok): for each child row with a parent, do two attributes agree? `pairs`: rule name ->
    (child column, parent column, whether two missing values agree). One join, one aggregate."""
    p = parent.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_p{i}") for i, (_, c, _) in enumerate(pairs.values())])
    j = child.join(p, F.col(key) == F.col("_key"))

    def differ(i: int, c: str, null_safe: bool):
        same = F.col(c).eqNullSafe(F.col(f"_p{i}")) if null_safe else F.coalesce(F.col(c) == F.col(f"_p{i}"), F.lit(False))
        return F.count_if(~same).alias(f"r{i}")
    agg = j.agg(F.count(F.lit(1)).alias("checked"), *[differ(i, c, n) for i, (c, _, n) in enumerate(pairs.values())])
    out = agg.select(F.inline(F.array(*[F.struct(F.lit(name).alias("rule"), F.col("checked"), F.col(f"r{i}").alias("violations"))
                                        for i, name in enumerate(pairs)])))
    return out.withColumn("ok", F.col("violations") == 0)


def ranges(values: DataFrame, limits: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """(quirk, value, low, high, ok) of the columns of a one-row frame against the range each must lie in (both ends
    included; None is open). A missing value is not ok."""
    rows = [F.struct(F.lit(n).alias("quirk"), F.col(n).cast("double").alias("value"), F.lit(lo).cast("double").alias("low"),
                     F.lit(hi).cast("double").alias("high")) for n, (lo, hi) in limits.items()]
    inside = (F.col("low").isNull() | (F.col("value") >= F.col("low"))) & (F.col("high").isNull() | (F.col("value") <= F.col("high")))
    return values.select(F.inline(F.array(*rows))).withColumn("ok", F.coalesce(inside, F.lit(False)))
