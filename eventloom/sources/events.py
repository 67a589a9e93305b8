"""Build event tables from any DataFrame, and read the text forms of event streams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.functions.derive import with_structured_fields, with_unstructured_fields
from eventloom.operators.chunks import CHUNK_BITS, broadcast_if_small, carry_before, chunk_of, required
from eventloom.operators.indexing import index_by_line
from eventloom.operators.templates import with_template
from eventloom.schema import (
    AUTO,
    AUTO_KEY,
    FILE,
    IDX,
    LEVEL,
    LOGTYPE,
    MESSAGE,
    OFFSET,
    STREAM,
    TS,
    USER,
    USER_KEY,
    VARS,
    ReaderOptions,
)
from eventloom.session import fresh_dir, settle


def as_variant(rows: DataFrame, column: Column) -> Column:
    """JSON text, a struct or map, or a VARIANT, as a VARIANT."""
    kind = rows.select(column.alias("c")).schema["c"].dataType
    if isinstance(kind, T.VariantType):
        return column
    if isinstance(kind, T.StringType):
        return F.try_parse_json(column)
    return F.to_variant_object(column)


def structured_events(
    rows: DataFrame,
    options: ReaderOptions,
    *,
    stream: Column,
    idx: Column,
    source_file: Column | None = None,
    auto: Column | None = None,
    user: Column | None = None,
) -> DataFrame:
    """A structured event table; a namespace that is not given is an empty object."""
    empty = F.parse_json(F.lit("{}"))
    events = rows.select(
        required(stream.cast("string"), STREAM).alias(STREAM),
        required(idx.cast("bigint"), IDX).alias(IDX),
        (F.lit(None) if source_file is None else source_file).cast("string").alias(FILE),
        (empty if auto is None else as_variant(rows, auto)).alias(AUTO),
        (empty if user is None else as_variant(rows, user)).alias(USER),
    )
    return with_structured_fields(events, options)


def unstructured_events(
    rows: DataFrame,
    *,
    stream: Column,
    idx: Column,
    message: Column,
    timestamp: Column,
    utc_offset_seconds: Column,
    source_file: Column | None = None,
) -> DataFrame:
    """An unstructured event table: each message as template and variables, and its own time."""
    events = rows.select(
        required(stream.cast("string"), STREAM).alias(STREAM),
        required(idx.cast("bigint"), IDX).alias(IDX),
        (F.lit(None) if source_file is None else source_file).cast("string").alias(FILE),
        message.alias(MESSAGE),
        timestamp.alias("_ts"),
        utc_offset_seconds.alias("_offset"),
    )
    events = with_unstructured_fields(with_template(events), F.col("_ts"), F.col("_offset"))
    return events.select(STREAM, IDX, FILE, LOGTYPE, VARS, LEVEL, TS, OFFSET)


def read_lines(spark: SparkSession, path: str, staged_at: str | None = None) -> DataFrame:
    """Text files as (value, source_path, line_number), lines numbered from 0 in each file."""
    lines = spark.read.text(path)
    return index_by_line(lines, staged_at or fresh_dir(spark, "lines"))


def read_structured_lines(
    spark: SparkSession, path: str, options: ReaderOptions, staged_at: str | None = None
) -> DataFrame:
    """Rendered structured messages, one JSON object per line, one stream per file.

    Lines that are not such an object have null key-value columns; see tolerant.split_broken.
    """
    lines = read_lines(spark, path, staged_at).withColumn("_v", F.try_parse_json("value"))
    return structured_events(
        lines,
        options,
        stream=F.col("source_path"),
        idx=F.col("line_number"),
        source_file=F.col("source_path"),
        auto=F.try_variant_get("_v", f"$['{AUTO_KEY}']", "variant"),
        user=F.try_variant_get("_v", f"$['{USER_KEY}']", "variant"),
    )


@dataclass(frozen=True)
class TextHead:
    """How the first line of a text event begins.

    `pattern` is a regular expression for the start of the line: group 1 is the local time, written in the
    datetime pattern `time`; group 2, if `has_offset`, is the UTC offset as Z, +hh:mm or +hhmm.
    """

    pattern: str = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3})(Z|[+-]\d{2}:?\d{2})"
    time: str = "yyyy-MM-dd HH:mm:ss.SSS"
    has_offset: bool = True
    default_offset_seconds: int = 0

    @property
    def at_start(self) -> str:
        return rf"\A(?:{self.pattern})"

    def offset_seconds(self, line: Column) -> Column:
        default = F.lit(self.default_offset_seconds).cast("bigint")
        if not self.has_offset:
            return default
        text = F.regexp_extract(line, self.at_start, 2)
        digits = F.regexp_replace(text, "[^0-9]", "")
        size = F.substring(digits, 1, 2).try_cast("bigint") * 3600 + F.substring(digits, 3, 2).try_cast("bigint") * 60
        found = F.when(text == "Z", F.lit(0).cast("bigint")).otherwise(F.when(text.startswith("-"), -size).otherwise(size))
        return F.coalesce(found, default)

    def millis(self, line: Column) -> Column:
        """Epoch milliseconds; read with a fixed zone, so the session's time zone plays no part."""
        local = F.try_to_timestamp(
            F.concat(F.regexp_extract(line, self.at_start, 1), F.lit(" +00:00")), F.lit(self.time + " XXX")
        )
        return F.unix_millis(local) - self.offset_seconds(line) * 1000


def read_unstructured_lines(
    spark: SparkSession,
    path: str,
    head: TextHead = TextHead(),
    staged_at: str | None = None,
    bits: int = CHUNK_BITS,
) -> DataFrame:
    """Text logs, one stream per file, as an unstructured event table; an event may span lines.

    A line that begins with the head starts an event, other lines belong to the event before them. The message
    is what follows the head, with the further lines after a newline each. Lines before a file's first head are
    one event with time and offset 0, and so is an event whose head has a time that does not exist (13th month).
    Spark ends lines at \\n, \\r\\n and \\r; empty files have no events.

    Lines are cut into chunks of 2**bits. Event numbers are running counts of heads in a chunk plus those before it;
    a chunk's lines are put together inside its task. Only the lines with which a chunk goes on with an earlier
    event are gathered by event. An event is one row, so one of many chunks must still fit in a row.
    """
    lines = read_lines(spark, path, staged_at).withColumns(
        {
            "_chunk": chunk_of(F.col("line_number"), bits),
            "_starts": (F.col("value").rlike(head.at_start) | (F.col("line_number") == 0)).cast("bigint"),
        }
    )
    first = F.min(F.when(F.col("_starts") == 1, F.col("line_number")))
    starts = settle(
        lines.groupBy("source_path", "_chunk").agg(F.sum("_starts").alias("_n"), first.alias("_own")), "head-counts"
    )
    before = carry_before(starts, ["source_path"], "_chunk", "_n", "sum", "_before").drop("_n")
    lines = lines.join(broadcast_if_small(before), ["source_path", "_chunk"])
    in_order = F.sort_array(F.collect_list(F.struct("line_number", "value")))
    rest = (
        lines.where(F.col("_own").isNull() | (F.col("line_number") < F.col("_own")))
        .groupBy("source_path", (F.col("_before") - 1).alias(IDX))
        .agg(F.array_join(in_order["value"], "\n").alias("_rest"))
    )
    running = Window.partitionBy("source_path", "_chunk").orderBy("line_number").rowsBetween(Window.unboundedPreceding, 0)
    events = (
        lines.where(F.col("line_number") >= F.col("_own"))
        .withColumn("_event", F.sum("_starts").over(running))
        .groupBy("source_path", "_chunk", "_event")
        .agg(F.first("_before").alias("_before"), in_order.alias("_lines"))
        .select(
            "source_path",
            (F.col("_before") + F.col("_event") - 1).alias(IDX),
            F.array_join(F.col("_lines.value"), "\n").alias("_text"),
            F.col("_lines")[0]["value"].alias("_first"),
        )
        .join(broadcast_if_small(settle(rest, "carried-lines")), ["source_path", IDX], "left")
    )
    is_head = F.col("_first").rlike(head.at_start)
    return unstructured_events(
        events,
        stream=F.col("source_path"),
        idx=F.col(IDX),
        source_file=F.col("source_path"),
        message=F.concat_ws("\n", F.regexp_replace("_text", head.at_start, ""), F.col("_rest")),
        timestamp=F.when(is_head, head.millis(F.col("_first"))),
        utc_offset_seconds=F.when(is_head, head.offset_seconds(F.col("_first"))),
    )
