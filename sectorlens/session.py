"""Session settings that the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app_name: str = "sectorlens") -> SparkSession:
    """A session for tests and the bench on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Small shuffles ahead of Python work still use all cores.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1KB")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make reliable checkpoints possible.

    The folder named in ``spark.checkpoint.dir`` is used.  Only a local session
    without that setting gets a temporary folder; on a cluster a machine-local
    folder would be lost with its machine, so a missing setting is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="sectorlens-checkpoint-")
    context.setCheckpointDir(folder)


def stored(df: DataFrame) -> DataFrame:
    """Write a stage as Parquet in the checkpoint folder and go on from there.

    Smaller than a checkpoint of rows and read by column, but without the order of its rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    folder = f"{df.sparkSession.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def checkpointed(df: DataFrame, name: str = "") -> DataFrame:
    """Write a stage to the checkpoint folder and go on from there.

    Worth it where a costly stage is read more than once.  The files survive the
    loss of executors.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
