"""One object per event table with the calls of a log viewer: filter, page, look up, list files."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.kept import leaf_of
from eventloom.functions.predicates import KvLeaf
from eventloom.operators import bitmaps, files, filters, nearest, paging
from eventloom.schema import STREAM, STRUCTURED, UNSTRUCTURED, KeyPath
from eventloom.session import settle
from eventloom.sources.admission import Opened
from eventloom.sources.store import of_stream, open_appended, open_events
from eventloom.sources.zones import open_zones


class LogTable:
    """An event table of one or many streams. Immutable: filter() returns a new one."""

    def __init__(
        self,
        events: DataFrame,
        stream_type: str = STRUCTURED,
        condition: Column | None = None,
        zones: DataFrame | None = None,
        kept: DataFrame | None = None,
    ) -> None:
        self.events = events
        self.zones = zones
        self.stream_type = stream_type
        self._condition = condition
        self._kept = kept
        self._counted: tuple[DataFrame, DataFrame] | None = None

    @classmethod
    def stored(cls, spark: SparkSession, path: str, stream_type: str = STRUCTURED) -> LogTable:
        """A table that store_events wrote, with its zone map: counts and lookups read the map first."""
        return cls(open_events(spark, path), stream_type, zones=open_zones(spark, path))

    @classmethod
    def appended(cls, spark: SparkSession, path: str, stream_type: str = STRUCTURED) -> LogTable:
        """A table that append_events grows, as of its complete loads now."""
        events, zones = open_appended(spark, path)
        return cls(events, stream_type, zones=zones)

    @classmethod
    def opened(cls, tables: Opened) -> tuple[LogTable, LogTable]:
        """The structured and the unstructured table of a catalog that open_streams stored."""
        return (
            cls(tables.structured, STRUCTURED, zones=tables.structured_zones),
            cls(tables.unstructured, UNSTRUCTURED, zones=tables.unstructured_zones),
        )

    def _match_counts(self) -> tuple[DataFrame, DataFrame]:
        """Matches before each chunk, and per stream: counted at first use, then read from the shared folder."""
        if self._counted is None and self._kept is not None:
            before, totals = bitmaps.offsets(self._kept, self.stream_type)
            self._counted = settle(before, "matches-before"), settle(totals, "match-totals")
        elif self._counted is None:
            before, totals = filters.match_offsets(self.events, self._condition, self.stream_type)
            self._counted = settle(before, "matches-before"), settle(totals, "match-totals")
        return self._counted

    def only(self, stream_id: str) -> LogTable:
        zones = None if self.zones is None else self.zones.where(F.col(STREAM) == stream_id)
        kept = None if self._kept is None else self._kept.where(F.col(STREAM) == stream_id)
        return LogTable(of_stream(self.events, stream_id), self.stream_type, self._condition, zones, kept)

    def event_counts(self) -> DataFrame:
        if self.zones is not None:
            return self.zones.groupBy(STREAM).agg(F.sum("n").alias("n_events"))
        return files.event_counts(self.events)

    def file_infos(self) -> DataFrame:
        return files.file_infos(self.events)

    def file_names(self) -> DataFrame:
        return files.file_names(self.events)

    def kv(self, *parts: str, auto: bool = False) -> KvLeaf:
        """functions.predicates.kv for this table: reads a kept key's plain columns if there are any."""
        return leaf_of(self.events, KeyPath(auto, parts))

    def filter(
        self, levels: Iterable[int] | None = None, predicate: Column | None = None
    ) -> LogTable:
        """Replaces any earlier filter; filter() with nothing removes it."""
        condition = filters.filter_condition(levels, predicate, self.stream_type)
        return LogTable(self.events, self.stream_type, condition, self.zones)

    def keep(self) -> LogTable:
        """The same table with its filter evaluated now, once, and kept as bitmaps (operators/bitmaps.py)."""
        if self._condition is None:
            raise ValueError("no filter to keep")
        kept = self._kept if self._kept is not None else bitmaps.match_bitmaps(self.events, self._condition)
        return LogTable(self.events, self.stream_type, self._condition, self.zones, kept)

    def _combined(self, other: LogTable, how: Callable[[DataFrame, DataFrame], DataFrame], condition: Column) -> LogTable:
        if self.events is not other.events:
            raise ValueError("kept filters are combined on one and the same table")
        return LogTable(self.events, self.stream_type, condition, self.zones, how(self._kept, other._kept))

    def __and__(self, other: LogTable) -> LogTable:
        """Both kept filters of one table; the events are not read."""
        self._both_kept(other)
        return self._combined(other, bitmaps.both, self._condition & other._condition)

    def __or__(self, other: LogTable) -> LogTable:
        """Either of two kept filters of one table; the events are not read."""
        self._both_kept(other)
        return self._combined(other, bitmaps.either, self._condition | other._condition)

    def _both_kept(self, other: LogTable) -> None:
        if self._kept is None or other._kept is None:
            raise ValueError("only kept filters combine: call keep() first")

    def filtered_events(self) -> DataFrame:
        return self.events if self._condition is None else self.events.where(self._condition)

    def filter_summary(self) -> DataFrame:
        return filters.filter_summary(self.events, self._condition, self.stream_type)

    def filtered_index_map(self) -> DataFrame | None:
        """Null without an active filter in any stream."""
        if self._condition is None:
            return None
        before, totals = self._match_counts()
        if self.stream_type == STRUCTURED and not totals.limit(1).count():
            return None
        if self._kept is not None:
            return bitmaps.unpack(self._kept, before.join(totals, STREAM, "left_semi"))
        return filters.index_map(self.events, self._condition, before, totals)

    def page(self, begin: int, end: int, use_filter: bool = False, strict: bool = False) -> DataFrame:
        if use_filter:
            counted = None if self._condition is None else self._match_counts()
            if self._kept is not None:
                return paging.page_kept(self.events, self._kept, begin, end, self.stream_type, strict, counted)
            return paging.page_filtered(
                self.events, self._condition, begin, end, self.stream_type, strict, counted=counted
            )
        return paging.page(self.events, begin, end, self.stream_type, strict)

    def nearest(self, target_ts: int) -> DataFrame:
        """Looks at all events, filtered or not."""
        if self.zones is not None:
            return nearest.nearest_stored(self.events, self.zones, target_ts)
        return nearest.nearest_event(self.events, target_ts)

    def nearest_many(self, probes: DataFrame, target: str = "target_ts") -> DataFrame:
        return nearest.nearest_events(self.events, probes, target)
