"""Corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), where docs are the rows its predecessor kept, and returns a
DataFrame; `run` writes it as Parquet to the shared folder and hands the reread table on. All
stages but the last return the columns of documents.

Edge cases: an empty table passes through every stage; null and empty texts fail the quality stage;
a document that line dedup leaves without a word goes; mixing repeats documents of small sources
up to twice and drops none; columns that documents carries besides its own are passed on, whatever
their names.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpilens.llm import line_dedup, minmax, mixing, packing, quality
from kpilens.llm.common import stored, table, word_count

#: The columns of documents; any others are carried through under names no stage uses.
OWN = ("doc_id", "text", "lang", "source", "n_chars")


def carrying_others(stage):
    """The stage with the table's further columns renamed round the call, whatever they are called."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inside = {c: c if c in OWN else f"__other{i}" for i, c in enumerate(docs.columns)}
        out = stage(spark, docs.toDF(*inside.values()), sf_dir)
        outside = {v: c for c, v in inside.items()}
        return out.toDF(*[outside.get(c, c) for c in out.columns])
    return run


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the base rule and the learned decision list accept."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later similar lines leave their document; documents without a word left go."""
    # asked of the counts, not of the new text: a filter on the text would be pushed into its lambdas
    out = line_dedup.dedup_lines(docs).where("n_lines > n_removed").select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each near-duplicate component."""
    return minmax.keep_one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights read them: each once at least, twice at most."""
    return mixing.mix(docs, max_repeat=2.0).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2,048 words; repeats of a document never share one."""
    return packing.pack(docs, word_count(F.col("text")), F.xxhash64("text"))


STAGES = [(name, carrying_others(stage)) for name, stage in (
    ("quality rules", quality_rules), ("line dedup", line_dedup_stage), ("near-dedup", near_dedup),
    ("mixing", mixing_stage), ("packing", packing_stage))]

#: SQL cannot express the learned list, min-max hashing and the sequential packing; tests/llm checks against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
