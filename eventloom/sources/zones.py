"""A zone map beside a stored event table: per stream and chunk of positions its count and its ends in position and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators.chunks import CHUNK_BITS, chunk_of
from eventloom.schema import IDX, STREAM, TS

ZONES = "_zones"  # Spark's file listing leaves out names that start with an underscore
CHUNK = "chunk"


def zones_of(events: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """One row per stream and chunk of 2**bits positions: n, min_idx, max_idx, min_ts, max_ts.

    Events without a time column have a map without min_ts and max_ts: counts read it, lookups by time raise.
    """
    times = [F.min(TS).alias("min_ts"), F.max(TS).alias("max_ts")] if TS in events.columns else []
    return events.groupBy(STREAM, chunk_of(F.col(IDX), bits).alias(CHUNK)).agg(
        F.count("*").alias("n"), F.min(IDX).alias("min_idx"), F.max(IDX).alias("max_idx"), *times
    )


def write_zones(spark: SparkSession, path: str, bits: int = CHUNK_BITS, mode: str = "errorifexists") -> None:
    """Three columns of the stored events are read once; the map itself has a row per chunk."""
    zones_of(spark.read.parquet(path), bits).write.mode(mode).parquet(f"{path.rstrip('/')}/{ZONES}")


def open_zones(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path.rstrip('/')}/{ZONES}")
