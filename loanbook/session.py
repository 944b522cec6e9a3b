"""Settings the reports expect of a session, a local session for tests, shared folders."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What a cluster session should carry. Sizes follow the data: partitions are cut
# by bytes and joined or split at run time, so no count depends on a table.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even where that costs one more shuffle after it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def local_session(cpus: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("loanbook")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # plans name whole paths, however deep a folder of tests lies
        .config("spark.sql.maxMetadataStringLength", "1000")
        # call-site capture of every Column is the larger part of building a plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder; it is set to a local one where unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="checkpoint-"))
    return os.path.join(context.getCheckpointDir(), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows, written once as Parquet in the shared folder and read from there.

    Lost executors cost nothing that was written, and later steps start from the file.
    ``options`` are those of the writer.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
