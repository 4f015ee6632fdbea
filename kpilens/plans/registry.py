"""Named queries: one callable (spark, sf_dir) -> DataFrame per operator key.

Default periods follow the rules: the last complete month (and the 3 months
ending there) against the previous period of equal length. Every double column
of a result is rounded to 6 digits, and every money sum is an exact DECIMAL sum
reported as DOUBLE, so that an independent SQL engine can reproduce the values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpilens.config import RATIO_DIGITS
from kpilens.plans.kpi import KPI

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
_KPI: dict[tuple[str, str], KPI] = {}


def kpi(spark: SparkSession, sf_dir: str) -> KPI:
    """One facade per (session, directory): the month list is computed once."""
    app = spark.sparkContext.applicationId
    for old in [k for k in _KPI if k[0] != app]:      # facades of ended applications
        del _KPI[old]
    key = (app, sf_dir.rstrip("/"))
    if key not in _KPI:
        _KPI[key] = KPI(spark, sf_dir)
    return _KPI[key]


def finish(df: DataFrame) -> DataFrame:
    """Round doubles to 6 digits, report decimals as doubles, integers as BIGINT and
    timestamps as text, so both engines return the same types."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), RATIO_DIGITS)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return deco


def periods(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    return kpi(spark, sf_dir).default_periods()


def queries() -> dict[str, Query]:
    # importing the query modules fills REGISTRY
    from kpilens.plans import q_constraints, q_core, q_explain, q_funnel, q_profile, q_reconcile, q_snapshot, q_whatif, q_grading  # noqa: F401
    return dict(REGISTRY)


__all__ = ["queries", "register", "kpi", "periods", "finish"]
