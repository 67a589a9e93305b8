"""Positions and the reports that need an order, on unbounded input.

Each micro-batch is a load of a growing table (sources/store.py): ordered inside the batch, its positions go on where
each stream ended. What a stream needs from its past is one row: last position, time and offset. These rows are a table
written anew by each batch, not keyed state in workers, so a stream that holds a third of all events is still numbered and
checked by many tasks. A batch that is tried again after a loss finds the state before it and gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventloom.operators import diagnostics
from eventloom.operators.chunks import CHUNK_BITS, broadcast_if_small
from eventloom.operators.indexing import index_by_rank
from eventloom.schema import IDX, OFFSET, STREAM, TS
from eventloom.session import settle
from eventloom.sources.store import BATCH, append_events

SLOTS = 3  # states kept; a batch reads the one before it and writes its own
_STATE = f"{STREAM} string, {IDX} bigint, {TS} bigint, {OFFSET} bigint, batch bigint"
_OFFSETS = f"{STREAM} string, {IDX} bigint, {OFFSET} bigint, previous_utc_offset bigint, batch bigint"
_ORDER = f"{STREAM} string, n_events bigint, n_inversions bigint, first_bad_idx bigint, batch bigint"


def append_positions(
    arriving: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    order: Sequence[str],
    path: str,
    checkpoint: str,
    bits: int = CHUNK_BITS,
    *,
    drain: bool = True,
) -> StreamingQuery:
    """Number arriving rows (with stream_id) and append them as events to the table at `path`.

    `order` is unique in a stream inside a micro-batch; between batches the order is that of arrival. `build` makes
    events from rows with log_event_idx. The table is read with LogTable.appended, the reports with the functions
    below. A checkpoint belongs to its table: start both anew or neither.
    """

    def load(batch: DataFrame, number: int) -> None:
        _load(batch, number, build, list(order), path.rstrip("/"), bits)

    writer = arriving.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()


def _load(batch: DataFrame, number: int, build: Callable[[DataFrame], DataFrame], order: list[str], path: str, bits: int) -> None:
    spark, name = batch.sparkSession, f"m{number}"
    past = _state(spark, path, number - 1)
    ends = past.select(STREAM, (F.col(IDX) + 1).alias("_base"))
    events = build(index_by_rank(settle(batch, "micro-batch"), order))
    append_events(events, path, name, bits, ends=ends)
    # From here on the written batch is read, also when it was complete before this try.
    narrow = events.select(STREAM, IDX, TS, OFFSET)
    stored = spark.read.schema(narrow.schema).parquet(f"{path}/{BATCH}=b-{name}").select(*narrow.columns)
    last = F.max_by(F.struct(TS, OFFSET), IDX)
    tails = settle(stored.groupBy(STREAM).agg(F.max(IDX).alias(IDX), last.alias("_v")), "batch-tails")
    before = past.join(broadcast_if_small(tails.select(STREAM)), STREAM, "left_semi").select(STREAM, IDX, TS, OFFSET)
    joined = stored.unionByName(before)  # each stream's last earlier event stands right before its new ones
    stamp = F.lit(number).cast("bigint").alias("batch")
    changes = diagnostics.offset_changes(joined, bits).select(STREAM, IDX, OFFSET, "previous_utc_offset", stamp)
    changes.write.mode("overwrite").parquet(f"{path}/_offset_changes/batch-{number}")
    found = diagnostics.chronology_check(joined, bits).join(
        broadcast_if_small(before.select(STREAM, F.lit(1).alias("_old"))), STREAM, "left"
    )
    own = (F.col("n_events") - F.coalesce("_old", F.lit(0))).alias("n_events")
    found.select(STREAM, own, "n_inversions", "first_bad_idx", stamp).write.mode("overwrite").parquet(
        f"{path}/_chronology/batch-{number}"
    )
    now = tails.select(STREAM, IDX, f"_v.{TS}", f"_v.{OFFSET}").unionByName(past.select(STREAM, IDX, TS, OFFSET))
    state = now.groupBy(STREAM).agg(F.max_by(F.struct(TS, OFFSET), IDX).alias("_v"), F.max(IDX).alias(IDX))
    state.select(STREAM, IDX, f"_v.{TS}", f"_v.{OFFSET}", stamp).write.mode("overwrite").parquet(
        f"{path}/_state/slot-{number % SLOTS}"
    )


def _state(spark: SparkSession, path: str, number: int) -> DataFrame:
    """Per stream its last event after this batch; before the first batch there is none."""
    if number < 0:
        return spark.createDataFrame([], _STATE)
    state = spark.read.schema(_STATE).parquet(f"{path}/_state/slot-{number % SLOTS}")
    other = state.where(F.col("batch") != number).limit(1).collect()
    if other:
        raise ValueError(f"the state of batch {number} is gone: found that of batch {other[0]['batch']}")
    return state


def _reports(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """The reports of all complete batches; a batch is complete when its state is written."""
    last = spark.read.schema(_STATE).parquet(f"{path.rstrip('/')}/_state/slot-*").agg(F.max("batch")).first()[0]
    rows = spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{name}/batch-*")
    return rows.where(F.col("batch") <= (-1 if last is None else last)).drop("batch")


def offset_changes_so_far(spark: SparkSession, path: str) -> DataFrame:
    """diagnostics.offset_changes of all that has arrived."""
    return _reports(spark, path, "_offset_changes", _OFFSETS)


def chronology_so_far(spark: SparkSession, path: str) -> DataFrame:
    """diagnostics.chronology_check of all that has arrived."""
    sums = _reports(spark, path, "_chronology", _ORDER).groupBy(STREAM).agg(
        F.sum("n_events").alias("n_events"), F.sum("n_inversions").alias("n_inversions"), F.min("first_bad_idx").alias("first_bad_idx")
    )
    return sums.withColumn("is_chronological", F.col("n_inversions") == 0)
