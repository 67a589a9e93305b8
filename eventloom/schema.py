"""Shared column names, fixed values and option types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Level codes are positions in this list, names are matched exactly.
LEVEL_NAMES = ("NONE", "TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL")
# The two keys of a rendered structured message.
AUTO_KEY = "auto-generated"
USER_KEY = "user-generated"
# Fixed value: text shown for an event that cannot be rendered.
EMPTY_MESSAGE = "{}"
# Fixed value: leading bytes of a single-file archive.
ARCHIVE_MAGIC = bytes([0xFD, 0x2F, 0xC5, 0x30])
# Marks a variable's place in a message template.
PLACEHOLDER = "\x11"

STREAM = "stream_id"
IDX = "log_event_idx"
FILE = "source_file"
AUTO = "auto_kv"
USER = "user_kv"
LOGTYPE = "logtype"
VARS = "vars"
MESSAGE = "message"
LEVEL = "log_level"
TS = "timestamp"
OFFSET = "utc_offset"

STRUCTURED = "structured"
UNSTRUCTURED = "unstructured"

DECODED = T.StructType(
    [
        T.StructField(STREAM, T.StringType()),
        T.StructField("log_event_num", T.LongType()),
        T.StructField(LEVEL, T.ByteType()),
        T.StructField(MESSAGE, T.StringType()),
        T.StructField(TS, T.LongType()),
        T.StructField(OFFSET, T.LongType()),
    ]
)


@dataclass(frozen=True)
class KeyPath:
    """A full root-to-leaf key path in one of an event's two namespaces."""

    auto_generated: bool
    parts: tuple[str, ...]

    def __post_init__(self) -> None:
        object.__setattr__(self, "parts", tuple(self.parts))

    @property
    def namespace(self) -> str:
        return "auto" if self.auto_generated else "user"

    @property
    def column(self) -> str:
        return AUTO if self.auto_generated else USER


@dataclass(frozen=True)
class ReaderOptions:
    """Where a structured event keeps its level, timestamp and UTC offset; None = nowhere."""

    log_level: KeyPath | None = None
    timestamp: KeyPath | None = None
    utc_offset: KeyPath | None = None

    def items(self) -> list[tuple[str, KeyPath, str]]:
        """(option name, path, type its leaf must have) for the options that are set."""
        wanted = (
            ("log_level", self.log_level, "STRING"),
            ("timestamp", self.timestamp, "BIGINT"),
            ("utc_offset", self.utc_offset, "BIGINT"),
        )
        return [(name, path, kind) for name, path, kind in wanted if path is not None]
