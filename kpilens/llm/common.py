"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpilens.session import ensure_checkpoint_dir

WORD_SEP = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"


def words(text: Column) -> Column:
    """Array of the words `[^\\x20\\x09-\\x0D]+` of a text; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SEP), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder on the storage the cluster shares (`spark.checkpoint.dir`)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/kpilens-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to shared storage and read it back: cuts the lineage, computes it once."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """Evaluate `value` once and use it several times inside `body` (a lambda over a column)."""
    return F.transform(F.array(value), body)[0]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
