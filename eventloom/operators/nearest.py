"""The last event at or before a time: for one time, or for a table of them.

The answer is the event with the greatest timestamp <= the target, the last one among ties; a target
before every event gets the stream's first event; a stream without events gets null. It is always a
position in the whole stream, never in a filtered list.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from eventloom.operators.chunks import BROADCAST_ROWS, broadcast_if_small, carry_before, chunk_of, small_enough
from eventloom.operators.paging import PAGE_RANGES, within
from eventloom.schema import IDX, STREAM, TS
from eventloom.session import settle
from eventloom.sources.store import BUCKET

# Time is cut into buckets of 2**20 ms (17.5 minutes). Within a bucket, time (20 bits) and index (43
# bits, 8.8e12 events per stream) fit one BIGINT that sorts like the pair, so "last event" is a plain
# max() that Spark combines before the shuffle in a hash aggregate.
BUCKET_BITS = 20
INDEX_BITS = 43


def _packed(bucket_bits: int) -> Column:
    in_bucket = F.col(TS) - F.shiftleft(chunk_of(F.col(TS), bucket_bits), bucket_bits)
    pair = F.shiftleft(in_bucket, INDEX_BITS).bitwiseOR(F.col(IDX))
    return F.when(F.col(IDX) < (1 << INDEX_BITS), pair).otherwise(
        F.raise_error(F.lit("event index needs more than 43 bits"))
    )


def _index_of(packed: Column) -> Column:
    return packed.bitwiseAND((1 << INDEX_BITS) - 1)


def nearest_event(events: DataFrame, target_ts: int) -> DataFrame:
    """(stream_id, log_event_idx) for one target time, one row per stream: one scan, no sort."""
    per_bucket = events.groupBy(STREAM, chunk_of(F.col(TS), BUCKET_BITS).alias("_bucket")).agg(
        F.max(F.when(F.col(TS) <= target_ts, _packed(BUCKET_BITS))).alias("_last"),
        F.min(IDX).alias("_first"),
    )
    latest = F.max_by("_last", F.when(F.col("_last").isNotNull(), F.col("_bucket")))
    return per_bucket.groupBy(STREAM).agg(
        F.coalesce(_index_of(latest), F.min("_first")).alias(IDX)
    )


def _zones_to_read(zones: DataFrame, target_ts: int) -> DataFrame:
    """(stream, min_idx, max_idx) of the chunks that can hold the answer.

    A chunk wholly at or before the target has its max_ts as its best time, one across it has at least min_ts. Chunks
    that can't reach the best of these bounds are out. Of whole chunks with equal best times the last one has the
    greatest index. In a stream in time order one or two chunks are left, however out of order it is, never too few.
    """
    before, across = F.col("max_ts") <= target_ts, (F.col("min_ts") <= target_ts) & (F.col("max_ts") > target_ts)
    found = zones.where(F.col("min_ts") <= target_ts)
    bounds = found.groupBy(STREAM).agg(
        F.max(F.when(before, F.col("max_ts")).otherwise(F.col("min_ts"))).alias("_bound"),
        F.max(F.when(before, F.struct("max_ts", "max_idx"))).alias("_last"),
    )
    last = before & (F.col("max_ts") >= F.col("_bound")) & F.col("_last").eqNullSafe(F.struct("max_ts", "max_idx"))
    return found.join(bounds, STREAM).where(across | last).select(STREAM, "min_idx", "max_idx")


def nearest_stored(events: DataFrame, zones: DataFrame, target_ts: int) -> DataFrame:
    """nearest_event from a stored table and its zone map: only chunks that can hold the answer are read.

    Up to 64 chunks are named one by one in the scan's condition, more are joined. Streams whose first event comes
    after the target are answered from the map alone.
    """
    wanted = settle(_zones_to_read(zones, target_ts), "nearest-chunks")
    named = wanted.limit(PAGE_RANGES + 1).collect()
    firsts = zones.groupBy(STREAM).agg(F.min("min_idx").alias("_first"))
    if not named:
        return firsts.select(STREAM, F.col("_first").alias(IDX))
    if len(named) <= PAGE_RANGES:
        rows = events.where(within([tuple(r) for r in named]))
        if BUCKET in events.columns:
            rows = rows.where(F.col(BUCKET).isin(sorted({_bucket(r[0]) for r in named})))
    else:
        ranges = wanted.withColumnsRenamed({"min_idx": "_low", "max_idx": "_high"})
        inside = [events[STREAM] == ranges[STREAM], F.col(IDX) >= F.col("_low"), F.col(IDX) <= F.col("_high")]
        rows = events.join(broadcast_if_small(ranges), inside, "left_semi")
    best = rows.where(F.col(TS) <= target_ts).groupBy(STREAM).agg(F.max(F.struct(TS, IDX))[IDX].alias("_best"))
    return firsts.join(best, STREAM, "left").select(STREAM, F.coalesce("_best", "_first").alias(IDX))


def _bucket(stream: str) -> str:
    return "b" + hashlib.md5(stream.encode()).hexdigest()[:2]


def nearest_events(
    events: DataFrame,
    probes: DataFrame,
    target: str = "target_ts",
    bucket_bits: int = BUCKET_BITS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Add log_event_idx to every probe row (stream_id, target): an as-of join per stream.

    Targets are numbers of milliseconds; a fraction is cut down to the whole one below it.

    Events with equal (stream, time) are reduced to their last index before anything is compared, and
    equal probes are answered once, so no repeated time makes a large group: a (stream, bucket) holds
    at most 2**20 distinct times. What lies before a bucket is carried over one row
    per bucket. Where the probes touch few buckets, only those buckets' events are compared.
    """
    if IDX in probes.columns:
        raise ValueError(f"the probe table already has a column {IDX}")
    if not isinstance(probes.schema[target].dataType, NumericType):
        raise TypeError(f"{target} must be a number of milliseconds, not {probes.schema[target].dataType.simpleString()}")
    probes = probes.withColumn("_target", F.floor(target).cast("bigint"))
    bucket = chunk_of(F.col(TS), bucket_bits)
    happened = events.select(STREAM, TS, IDX, bucket.alias("_bucket"), F.lit(False).alias("_asked"))
    asked = (
        probes.where(F.col("_target").isNotNull())
        .select(STREAM, F.col("_target").alias(TS))
        .select(STREAM, TS, F.lit(None).cast("bigint").alias(IDX), bucket.alias("_bucket"), F.lit(True).alias("_asked"))
    )

    # One row per bucket that holds events or probes.
    buckets = settle(
        happened.unionByName(asked)
        .groupBy(STREAM, "_bucket")
        .agg(
            _index_of(F.max(F.when(~F.col("_asked"), _packed(bucket_bits)))).alias("_end"),
            F.min(IDX).alias("_min"),
            F.bool_or("_asked").alias("_asked"),
        ),
        "time-buckets",
    )
    first = buckets.groupBy(STREAM).agg(F.min("_min").alias("_first"))
    before = (
        carry_before(buckets, [STREAM], "_bucket", "_end", "last", "_before", span_bits=20)
        .where("_asked")
        .join(first, STREAM)
        .select(STREAM, "_bucket", F.coalesce("_before", "_first").alias("_before"))
    )
    asked_buckets = buckets.where("_asked").select(STREAM, "_bucket")
    if small_enough(asked_buckets, broadcast_rows):
        happened = happened.join(F.broadcast(asked_buckets), [STREAM, "_bucket"], "left_semi")

    # One row per time of an event or probe, then the last event up to each time in its bucket.
    times = (
        happened.unionByName(asked)
        .groupBy(STREAM, "_bucket", TS)
        .agg(F.max(IDX).alias("_idx"), F.bool_or("_asked").alias("_asked"))
    )
    up_to = (
        Window.partitionBy(STREAM, "_bucket")
        .orderBy(TS)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    answers = (
        times.withColumn("_idx", F.last("_idx", ignorenulls=True).over(up_to))
        .where("_asked")
        .join(before, [STREAM, "_bucket"])
        .select(STREAM, F.col(TS).alias("_target"), F.coalesce("_idx", "_before").alias(IDX))
    )
    return probes.join(answers, [STREAM, "_target"], "left").drop("_target")
