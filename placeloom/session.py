"""Session settings and lineage cutting."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job here relies on. They are session-level, so they can be applied to a session
# someone else built (see `tune`).
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Few bytes can become many rows (a box and its cells): small shuffles are dealt over all cores, too, not put together up to 1 MB.
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def broadcast_measured(spark: SparkSession) -> SparkSession:
    """Tables are broadcast by the size their rows turned out to have, up to the session's limit. The estimate that a plan starts with
    counts none of the rows an explode makes, so cells of a small table would pass for small and fill the driver."""
    planned, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    if not spark.conf.get(measured, None):
        spark.conf.set(measured, spark.conf.get(planned))
    spark.conf.set(planned, "-1")
    return spark


def small_shares(spark: SparkSession) -> SparkSession:
    """A task reads at most about 16 MB of a shuffle: rows packed there, sorted and grouped by several operators at once take tens of times
    as much memory. More input makes more tasks, as long as `spark.sql.shuffle.partitions` allows."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    # A Python worker holds a batch of whole texts.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def build_session(app: str = "placeloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` written as a Parquet table in the cluster's shared folder (`spark.checkpoint.dir`) and read back.

    A checkpoint of the rows themselves is written and read by Java's serializer, tens of microseconds a row. A folder
    of our own is set only where the cluster names none and Spark runs in one process."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder")
            folder = tempfile.mkdtemp(prefix="spark-")
        sc.setCheckpointDir(folder)
    path = f"{sc.getCheckpointDir()}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
