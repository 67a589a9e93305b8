"""The stateless part of the library on unbounded input.

Deriving fields, filtering and rendering look at one event at a time, so the batch functions work on
a streaming DataFrame unchanged. Positions, pages, filtered lists and nearest-event lookups need a
whole stream's order and stay batch operations on the table this writes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventloom.operators.filters import filter_events
from eventloom.schema import STRUCTURED


def normalise(
    arriving: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    levels: Iterable[int] | None = None,
    predicate: Column | None = None,
    stream_type: str = STRUCTURED,
) -> DataFrame:
    """Arriving rows as filtered events; `build` is the same function a batch load uses."""
    return filter_events(build(arriving), levels, predicate, stream_type)


def append_to(events: DataFrame, path: str, checkpoint: str, *, drain: bool = True) -> StreamingQuery:
    """Append events to a parquet table, exactly once per input row.

    drain=True takes what is there and stops; both folders must be on shared storage.
    """
    writer = (
        events.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()
