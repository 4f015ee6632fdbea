"""B7 as a stream: sessionise events as they arrive (Structured Streaming).

`session_window` + `withWatermark` in append mode: a session is emitted once the
watermark passes its end (last event + gap), with the same columns as the batch
`sessions_from_events`. State is bounded by the watermark, and the checkpoint goes
to the cluster's shared checkpoint folder, so a lost executor or a restarted
driver resumes from the last committed batch.

One difference from the batch rule: `session_window` starts a new session when
the gap is >= the threshold; the batch rule (and the reference) when it is >.
They differ only for two events exactly `gap` apart.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kpilens.config import ANON_USER_MODULO, SESSION_GAP_HOURS
from kpilens.session import ensure_checkpoint_dir
from kpilens.sources.tables import SCHEMAS


def read_events_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Events as a stream from a parquet folder, or from one file / glob inside a folder
    (explicit schema, no inference)."""
    r = spark.readStream.schema(SCHEMAS["events"])
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if path.endswith(".parquet") and not any(c in path for c in "*?["):
        # the file source takes folders or globs: a one-file glob stands for the file
        folder, name = path.rsplit("/", 1)
        stem = name[: -len(".parquet")]
        path = f"{folder}/{stem[:-1]}[{stem[-1]}].parquet"
    return r.parquet(path)


def sessionize_stream(events: DataFrame, gap_hours: int = SESSION_GAP_HOURS, watermark: str = "1 day") -> DataFrame:
    """Streaming sessions: one row per closed session."""
    e = events.withColumn("event_time", F.col("ts").cast("timestamp")).withWatermark("event_time", watermark)
    k = F.get_json_object("props", "$.k").cast("long")
    s = (e.groupBy("user_id", F.session_window("event_time", f"{gap_hours} hours").alias("sw"))
          .agg(F.min_by(k, F.struct("ts", "event_id")).alias("k"),
               F.min("ts").alias("started_at"),
               F.count(F.lit(1)).alias("n_events"),
               F.bool_or(F.col("event_type") == "view").alias("saw_product"),
               F.bool_or(F.col("event_type") == "click").alias("added_to_cart"),
               F.bool_or(F.col("event_type") == "purchase").alias("purchased")))
    return s.select(
        F.col("user_id").alias("raw_user_id"),
        F.when(F.col("user_id") % ANON_USER_MODULO != 0, F.col("user_id")).alias("user_id"),
        F.concat(F.lit("S"), (F.col("k") % 5).cast("string")).alias("traffic_source"),
        F.concat(F.lit("B"), (F.col("k") % 4).cast("string")).alias("browser"),
        "started_at", "n_events", "saw_product", "added_to_cart", "purchased",
        F.date_format(F.date_trunc("week", "started_at"), "yyyy-MM-dd").alias("period"))


def start_sessions_sink(sessions: DataFrame, out_path: str, checkpoint: str | None = None,
                        available_now: bool = True) -> StreamingQuery:
    """Append closed sessions to a parquet folder; the checkpoint defaults to a fresh folder
    under the session's checkpoint directory (the cluster's shared storage)."""
    spark = sessions.sparkSession
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/sessions-stream-{uuid.uuid4().hex}"
    w = (sessions.writeStream.format("parquet").outputMode("append")
                 .option("path", out_path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
