"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("eventloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: spark.checkpoint.dir, else the context's checkpoint folder.

    Only a session on one machine, as in tests, may do without and gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines share (master is {master})")
    return _temporary_dir()


@functools.cache
def _temporary_dir() -> str:
    return tempfile.mkdtemp(prefix="eventloom-")


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name inside the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def settle(frame: DataFrame, label: str) -> DataFrame:
    """Compute a small summary once, into the shared folder, and go on from the written copy.

    Whatever uses a summary several times would otherwise scan the events again for each use. The
    copy also has a known size, and stays the same when executors are lost.
    """
    spark = frame.sparkSession
    path = fresh_dir(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
