"""The three typed columns derived from every event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.keypaths import integer_at, string_at
from eventloom.functions.levels import level_from_logtype, level_from_name
from eventloom.schema import LEVEL, LOGTYPE, OFFSET, TS, ReaderOptions


def seconds_to_minutes(seconds: Column) -> Column:
    """Whole minutes, cut toward zero."""
    return F.call_function("div", seconds.cast("bigint"), F.lit(60).cast("bigint"))


def ntz_to_millis(ts: Column) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ read as UTC, whatever the session time zone."""
    since = ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.floor(since.cast("interval second").cast("decimal(18,6)") * 1000).cast("bigint")


def with_structured_fields(events: DataFrame, options: ReaderOptions) -> DataFrame:
    """Add log_level, timestamp and utc_offset from the key-value pairs; 0 where not derivable."""
    zero = F.lit(0).cast("bigint")
    return events.withColumns(
        {
            LEVEL: level_from_name(string_at(options.log_level)),
            TS: F.coalesce(integer_at(options.timestamp), zero),
            OFFSET: F.coalesce(seconds_to_minutes(integer_at(options.utc_offset)), zero),
        }
    )


def with_unstructured_fields(
    events: DataFrame, timestamp: Column, utc_offset_seconds: Column
) -> DataFrame:
    """Add log_level from the template, and the event's own timestamp and offset; null ones are 0."""
    zero = F.lit(0).cast("bigint")
    return events.withColumns(
        {
            LEVEL: level_from_logtype(F.col(LOGTYPE)),
            TS: F.coalesce(timestamp.cast("bigint"), zero),
            OFFSET: F.coalesce(seconds_to_minutes(utc_offset_seconds), zero),
        }
    )
