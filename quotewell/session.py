"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# A shuffle starts with many partitions and AQE merges the small ones to the advisory size; it splits skewed
# ones even where that costs a further shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(
    app: str = "quotewell",
    master: str | None = None,
    shuffle_partitions: int = 4096,
    **extra: str,
) -> SparkSession:
    """A session with the settings above; `master` stays unset under spark-submit.

    4096 shuffle partitions suit a large cluster (raise them with the data); pass the core count on one machine.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the folder the cluster names in spark.checkpoint.dir.

    Where that setting is absent a job on one machine takes a temporary folder; a cluster job fails, as its executors
    would each write to a disk of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="run-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: used several times, they are computed once, and a lost
    executor costs no more than one task's work."""
    df.write.parquet(path := shared_dir(df.sparkSession, label))
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure `DataFrame.checkpoint` has a folder, keeping the one already set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark, "checkpoint"))
