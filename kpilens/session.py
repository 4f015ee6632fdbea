"""Spark session for tests and the bench; on a cluster the caller's session is used."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "kpilens", cpus: int | str = "*", shuffle_partitions: int = 8,
              extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.autoBroadcastJoinThreshold", str(1 << 20))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the one already active on the context, else the
    cluster's shared `spark.checkpoint.dir` from the session, else (local tests only,
    when nothing is set) a scratch folder."""
    sc = spark.sparkContext
    active = sc.getCheckpointDir()
    if active:
        return active
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage: "
                               "checkpoints must survive the loss of any one machine")
        d = tempfile.mkdtemp(prefix="kpilens-ckpt-")   # local runs (tests) only
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def kept(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """A frame written once (default: under the shared checkpoint folder) and read back: whoever reads it several times
    computes it once, and a join sees its real size, so a small one is broadcast and a large one is not."""
    path = path or f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/kpilens-{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
