"""Keep an event table in parquet so that one stream's events are found without opening the rest."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.kept import kept_columns
from eventloom.operators.chunks import CHUNK_BITS, broadcast_if_small
from eventloom.schema import IDX, STREAM, TS
from eventloom.sources.zones import CHUNK, ZONES, write_zones, zones_of

BATCH = "load_batch"
COMMITS = "_commits"
# One of 256 folders per stream; the letter keeps Spark from reading some folder names as numbers.
BUCKET = "stream_bucket"


def bucket_of(stream: Column) -> Column:
    return F.concat(F.lit("b"), F.substring(F.md5(stream.cast("binary")), 1, 2))


def _write(events: DataFrame, path: str, mode: str) -> None:
    (
        events.withColumn(BUCKET, bucket_of(F.col(STREAM)))
        .hint("rebalance", F.col(BUCKET))
        .sortWithinPartitions(BUCKET, STREAM, IDX)
        .write.mode(mode)
        .partitionBy(BUCKET)
        .parquet(path)
    )


def store_events(events: DataFrame, path: str, mode: str = "errorifexists", bits: int = CHUNK_BITS) -> None:
    """Write events by stream bucket, each file sorted by stream and position, and a zone map of chunks of 2**bits positions.

    Events are gathered by bucket first, so the number of files follows the size of the table, not
    tasks times buckets. Adaptive execution cuts a bucket with a long stream into several tasks and
    merges small ones, to about spark.sql.adaptive.advisoryPartitionSizeInBytes each. The sort gives
    every row group narrow ranges of streams and positions to be skipped by.
    """
    _write(events, path, mode)
    write_zones(events.sparkSession, path, bits, mode)


def open_events(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def of_stream(events: DataFrame, stream_id: str) -> DataFrame:
    """One stream's events; on a stored table only its bucket's files are listed and read."""
    found = events.where(F.col(STREAM) == stream_id)
    if BUCKET in events.columns:
        found = found.where(F.col(BUCKET) == bucket_of(F.lit(stream_id)))
    return found


def _batches(spark: SparkSession, path: str) -> list[str]:
    """The loads that are complete: one name per load."""
    try:
        commits = spark.read.parquet(f"{path.rstrip('/')}/{COMMITS}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(row[BATCH] for row in commits.select(BATCH).distinct().collect())


def _appended_zones(spark: SparkSession, path: str, batches: list[str]) -> DataFrame:
    """The zone map of all complete loads; where several meet in a chunk, its row is put together."""
    zones = spark.read.parquet(f"{path.rstrip('/')}/{ZONES}").where(F.col(BATCH).isin(batches))
    return zones.groupBy(STREAM, CHUNK).agg(
        F.sum("n").alias("n"), *[F.min(c).alias(c) for c in ("min_idx", "min_ts")], *[F.max(c).alias(c) for c in ("max_idx", "max_ts")]
    )


def _is_complete(spark: SparkSession, root: str, folder: str) -> bool:
    try:
        spark.read.parquet(f"{root}/{COMMITS}/{folder}")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _check_kept(events: DataFrame, root: str) -> None:
    """All loads keep the same keys: a load without a key's columns would read as events without that key."""
    try:
        known = kept_columns(events.sparkSession.read.parquet(root))
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # nothing but empty loads
            return
        raise
    if known != kept_columns(events):
        raise ValueError(f"kept keys differ from those of earlier loads: {sorted(known ^ kept_columns(events))}")


def append_events(
    events: DataFrame, path: str, batch: str, bits: int = CHUNK_BITS, ends: DataFrame | None = None
) -> bool:
    """Add a load to a growing table: its events, at positions from 0 in each stream, go on where the stream ended.

    Returns False, and reads no event, if this batch is complete already, so a load may be tried again at
    any time. A batch has folders of its own for events and zones and counts once its commit, a single file, is
    written last; what a broken try left behind is never read, and is overwritten by the next. Where streams end
    comes from the zone map, not from the events. A stream whose count does not fit its first and last position
    raises, and nothing is added (a repeat that makes up for a gap is not noticed). One load at a time: two at once would number the same positions. All loads use the same `bits`.

    A caller that knows where each stream ended gives `ends` (stream_id, _base); then no other load is looked at.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError(f"batch name {batch!r}: only letters, digits and _.- are allowed")
    spark, root, folder = events.sparkSession, path.rstrip("/"), f"{BATCH}=b-{batch}"
    if ends is not None:
        if _is_complete(spark, root, folder):
            return False
    else:
        done = _batches(spark, root)
        if f"b-{batch}" in done:
            return False
        if done:
            _check_kept(events, root)
            ends = _appended_zones(spark, root, done).groupBy(STREAM).agg((F.max("max_idx") + 1).alias("_base"))
    moved = events
    if ends is not None:
        moved = events.join(broadcast_if_small(ends), STREAM, "left")
        moved = moved.withColumn(IDX, F.col(IDX) + F.coalesce("_base", F.lit(0))).select(*events.columns)
    _write(moved, f"{root}/{folder}", "overwrite")
    zones = zones_of(spark.read.schema(moved.select(STREAM, IDX, TS).schema).parquet(f"{root}/{folder}"), bits)
    zones.write.mode("overwrite").parquet(f"{root}/{ZONES}/{folder}")
    added = spark.read.schema(zones.schema).parquet(f"{root}/{ZONES}/{folder}").groupBy(STREAM).agg(
        F.sum("n").alias("n"), F.min("min_idx").alias("low"), F.max("max_idx").alias("high")
    )
    base = F.lit(0)
    if ends is not None:
        added, base = added.join(ends, STREAM, "left"), F.coalesce("_base", F.lit(0))
    holes = added.where((F.col("low") != base) | (F.col("high") - F.col("low") + 1 != F.col("n"))).limit(1).collect()
    if holes:
        raise ValueError(f"positions of stream {holes[0][STREAM]!r} in batch {batch!r} are not dense from 0")
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{root}/{COMMITS}/{folder}")
    return True


def open_appended(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Events and zone map of all complete loads of a table that append_events wrote."""
    batches = _batches(spark, path)
    if not batches:
        raise ValueError(f"no complete load in {path!r}")
    return spark.read.parquet(path).where(F.col(BATCH).isin(batches)).drop(BATCH), _appended_zones(spark, path, batches)
