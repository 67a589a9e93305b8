"""Which streams can be opened, and as what; a stream's metadata."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.derive import with_structured_fields, with_unstructured_fields
from eventloom.operators.chunks import CHUNK_BITS, broadcast_if_small, required
from eventloom.operators.templates import with_template
from eventloom.schema import (
    AUTO,
    FILE,
    IDX,
    LEVEL,
    LOGTYPE,
    MESSAGE,
    OFFSET,
    STREAM,
    STRUCTURED,
    TS,
    UNSTRUCTURED,
    USER,
    VARS,
    ReaderOptions,
)
from eventloom.session import settle
from eventloom.sources.events import as_variant
from eventloom.sources.store import BUCKET, bucket_of
from eventloom.sources.zones import ZONES, zones_of

METADATA_CORRUPTED = "metadata_corrupted"
UNSUPPORTED = "unsupported"


def classify_streams(
    streams: DataFrame,
    *,
    four_byte: Column,
    metadata_json: Column,
    supported: Sequence[str],
    backward_compatible: Sequence[str],
    version_key: str = "VERSION",
) -> DataFrame:
    """Add metadata, version, admission and stream_type to a catalog of streams.

    Checked in this order: encoding, metadata, version. `supported` versions are structured streams,
    `backward_compatible` ones unstructured, anything else is unsupported.
    """
    parsed = streams.withColumns(
        {"metadata": F.try_parse_json(metadata_json), "_four_byte": four_byte}
    )
    found = F.element_at(F.col("metadata").try_cast("map<string,variant>"), version_key)
    version = F.when(F.schema_of_variant(found) == "STRING", F.try_variant_get(found, "$", "string"))
    admission = (
        F.when(~F.coalesce(F.col("_four_byte"), F.lit(False)), UNSUPPORTED)
        .when(F.col("version").isNull(), METADATA_CORRUPTED)
        .when(F.col("version").isin(list(supported)), STRUCTURED)
        .when(F.col("version").isin(list(backward_compatible)), UNSTRUCTURED)
        .otherwise(UNSUPPORTED)
    )
    return (
        parsed.withColumn("version", version)
        .withColumn("admission", admission)
        .withColumn(
            "stream_type",
            F.when(F.col("admission").isin(STRUCTURED, UNSTRUCTURED), F.col("admission")),
        )
        .drop("_four_byte")
    )


class StreamRefusedError(ValueError):
    """A stream that cannot be opened."""


def admitted(
    rows: DataFrame, classified: DataFrame, stream_type: str, strict: bool = False
) -> DataFrame:
    """The rows of streams admitted as one type. strict=True raises if any stream was refused.

    The list of stream names is broadcast if it is counted to be small; the rows are then not moved.
    """
    if strict:
        refused = classified.where(F.col("stream_type").isNull()).limit(1).collect()
        if refused:
            raise StreamRefusedError(f"stream {refused[0][STREAM]!r}: {refused[0]['admission']}")
    names = classified.where(F.col("stream_type") == stream_type).select(STREAM)
    return rows.join(broadcast_if_small(names), STREAM, "left_semi")


@dataclass(frozen=True)
class Opened:
    """Both event tables of a catalog's streams, their zone maps, and the streams that were refused."""

    structured: DataFrame
    unstructured: DataFrame
    structured_zones: DataFrame
    unstructured_zones: DataFrame
    refused: DataFrame


def open_streams(
    rows: DataFrame,
    classified: DataFrame,
    options: ReaderOptions,
    path: str,
    *,
    stream: Column,
    idx: Column,
    auto: Column,
    user: Column,
    message: Column,
    timestamp: Column,
    utc_offset_seconds: Column,
    source_file: Column | None = None,
    strict: bool = False,
    bits: int = CHUNK_BITS,
) -> Opened:
    """Read raw rows of many streams, each as the type its catalog row admits it as, and store them under `path`.

    `auto` and `user` are used for rows of structured streams, `message`, `timestamp` and `utc_offset_seconds` for
    those of unstructured ones. The catalog (from classify_streams) is computed once and kept. One join brings the type to the
    rows, without moving them where the catalog is counted to be small, and one write lays them out by type
    and stream bucket, sorted by stream and position. A stream listed twice in the catalog is an error, one
    that is not listed is not opened. strict=True raises if the catalog holds a refused stream; otherwise `refused` lists
    them as (stream_id, admission). A type without events is an empty table.
    """
    spark = rows.sparkSession
    catalog = settle(classified.select(STREAM, "admission", "stream_type"), "catalog")
    again = catalog.groupBy(STREAM).count().where("count > 1").limit(1).collect()
    if again:
        raise ValueError(f"stream {again[0][STREAM]!r} is in the catalog {again[0]['count']} times")
    refused = catalog.where(F.col("stream_type").isNull()).select(STREAM, "admission")
    if strict:
        for row in refused.limit(1).collect():
            raise StreamRefusedError(f"stream {row[STREAM]!r}: {row['admission']}")
    types = catalog.where(F.col("stream_type").isNotNull()).select(STREAM, "stream_type")
    structured, unstructured = F.col("stream_type") == STRUCTURED, F.col("stream_type") == UNSTRUCTURED
    raw = rows.select(
        required(stream.cast("string"), STREAM).alias(STREAM),
        required(idx.cast("bigint"), IDX).alias(IDX),
        (F.lit(None) if source_file is None else source_file).cast("string").alias(FILE),
        as_variant(rows, auto).alias(AUTO),
        as_variant(rows, user).alias(USER),
        message.alias(MESSAGE),
        timestamp.alias("_ts"),
        utc_offset_seconds.alias("_offset"),
    )
    typed = raw.join(broadcast_if_small(types), STREAM).withColumns(
        {AUTO: F.when(structured, F.col(AUTO)), USER: F.when(structured, F.col(USER)), MESSAGE: F.when(unstructured, F.col(MESSAGE))}
    )
    derived = (LEVEL, TS, OFFSET)
    typed = with_structured_fields(typed, options).withColumnsRenamed({name: f"_{name}" for name in derived})
    typed = with_unstructured_fields(with_template(typed), F.col("_ts"), F.col("_offset"))
    events = typed.select(
        STREAM, IDX, FILE, AUTO, USER, LOGTYPE, VARS,
        *[F.when(structured, F.col(f"_{name}")).otherwise(F.col(name)).alias(name) for name in derived],
        "stream_type",
        bucket_of(F.col(STREAM)).alias(BUCKET),
    )
    (
        events.hint("rebalance", "stream_type", BUCKET)
        .sortWithinPartitions("stream_type", BUCKET, STREAM, IDX)
        .write.partitionBy("stream_type", BUCKET)
        .parquet(path)
    )
    stored = spark.read.schema(events.schema).parquet(path)
    common = [STREAM, IDX, FILE, LEVEL, TS, OFFSET, BUCKET]
    tables, zones = [], []
    for kind, own in ((STRUCTURED, (AUTO, USER)), (UNSTRUCTURED, (LOGTYPE, VARS))):
        table = stored.where(F.col("stream_type") == kind).select(*common[:3], *own, *common[3:])
        counted, folder = zones_of(table, bits), f"{path.rstrip('/')}/{ZONES}/{kind}"
        counted.write.parquet(folder)
        tables.append(table)
        zones.append(spark.read.schema(counted.schema).parquet(folder))
    return Opened(*tables, *zones, refused)


def metadata_entries(streams: DataFrame, metadata: str = "metadata") -> DataFrame:
    """(stream_id, key, value as JSON text): the top-level entries of each stream's metadata."""
    entries = F.explode(F.col(metadata).try_cast("map<string,variant>"))
    return streams.select(STREAM, entries.alias("key", "_value")).select(
        STREAM, "key", F.to_json("_value").alias("value")
    )
