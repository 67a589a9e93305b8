"""Event tables over the given parquet tables, as the registered queries see them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.derive import ntz_to_millis
from eventloom.operators.indexing import index_by_order, index_by_ordinal_files
from eventloom.operators.templates import with_template
from eventloom.schema import IDX, STREAM, KeyPath, ReaderOptions
from eventloom.sources.events import structured_events, unstructured_events

OPTIONS = ReaderOptions(
    log_level=KeyPath(True, ("level",)),
    timestamp=KeyPath(True, ("timestamp",)),
    utc_offset=KeyPath(True, ("utc_offset",)),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def level_text() -> Column:
    return (
        F.when(F.col("event_type") == "error", "Error")
        .when(F.col("event_type") == "signup", "warn")
        .when(F.col("event_type") == "purchase", "INFO")
        .when(F.col("event_type") == "click", "debug")
        .otherwise(F.col("event_type"))
    )


def offset_seconds() -> Column:
    return (F.col("user_id") % 5 - 2) * 5400 - 59


def source_file() -> Column:
    return F.concat(F.lit("f"), F.expr("event_id div 1000"))


def auto_pairs(millis: Column | None = None) -> Column:
    millis = ntz_to_millis(F.col("ts")) if millis is None else millis
    return F.struct(
        level_text().alias("level"),
        millis.alias("timestamp"),
        offset_seconds().alias("utc_offset"),
    )


def build_structured(
    rows: DataFrame, stream: Column, idx: Column, millis: Column | None = None
) -> DataFrame:
    return structured_events(
        rows, OPTIONS, stream=stream, idx=idx, source_file=source_file(), auto=auto_pairs(millis), user=F.col("props")
    )


def one_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of `events` as a single stream in its own order."""
    return build_structured(table(spark, sf_dir, "events"), F.lit("all"), F.col("event_id"))


def four_streams(spark: SparkSession, sf_dir: str, millis: Column | None = None) -> DataFrame:
    """`events` dealt to four streams by user, each with its own positions."""
    rows = table(spark, sf_dir, "events").withColumn(
        STREAM, F.concat(F.lit("s"), F.col("user_id") % 4)
    )
    return build_structured(index_by_order(rows, "event_id"), F.col(STREAM), F.col(IDX), millis)


def coarse_millis() -> Column:
    """Times cut to ten minutes, so that many events share one."""
    ten_minutes = F.lit(600_000).cast("bigint")
    return F.call_function("div", ntz_to_millis(F.col("ts")), ten_minutes) * ten_minutes


def text_message() -> Column:
    return F.concat(
        F.lit(" "), F.upper("event_type"), F.lit(" user="), F.col("user_id"), F.lit(" props="), F.col("props")
    )


def text_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as one unstructured stream with messages like ' ERROR user=8 props={"k": 69}'."""
    return unstructured_events(
        table(spark, sf_dir, "events"),
        stream=F.lit("all"),
        idx=F.col("event_id"),
        source_file=source_file(),
        message=text_message(),
        timestamp=ntz_to_millis(F.col("ts")),
        utc_offset_seconds=offset_seconds(),
    )


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of `documents`: a stream per source, a file per document; adds line, logtype and vars."""
    docs = table(spark, sf_dir, "documents")
    lines = docs.select(
        F.col("source").alias(STREAM),
        "doc_id",
        F.posexplode(F.split("text", "\n")).alias("line_number", "line"),
    )
    # Positions need only the keys; the text joins no shuffle unless there are very many documents.
    return with_template(index_by_ordinal_files(lines, "doc_id", "line_number"), F.col("line"))


def irregular_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` with absent, empty and wrongly typed values, by event_id."""
    e = F.col("event_id")
    number = F.get_json_object("props", "$.k")
    level = (
        F.when(e % 7 == 0, '"level":"Error"')
        .when(e % 7 == 1, '"level":"warn"')
        .when(e % 7 == 2, '"level":null')
        .when(e % 7 == 4, '"level":5')
        .when(e % 7 == 5, '"level":"nope"')
        .when(e % 7 == 6, '"level":"INFO"')
    )
    stamp = (
        F.when(e % 5 == 0, F.concat(F.lit('"timestamp":"'), e, F.lit('"')))
        .when(e % 5 == 1, '"timestamp":null')
        .otherwise(F.concat(F.lit('"timestamp":'), e))
    )
    offset = F.when(e % 3 == 0, '"utc_offset":1.5').otherwise(
        F.concat(F.lit('"utc_offset":'), offset_seconds())
    )
    auto = F.concat(F.lit("{"), F.concat_ws(",", level, stamp, offset), F.lit("}"))
    user = (
        F.when(e % 7 == 0, F.concat(F.lit('{"k":'), number, F.lit("}")))
        .when(e % 7 == 1, F.concat(F.lit('{"k":"'), number, F.lit('"}')))
        .when(e % 7 == 2, '{"k":null}')
        .when(e % 7 == 3, "{}")
        .when(e % 7 == 4, F.concat(F.lit('{"k":{"a":'), number, F.lit("}}")))
        .when(e % 7 == 5, F.concat(F.lit('{"k":'), number, F.lit(".5}")))
        .otherwise('{"k":{"a":{"b":true}},"list":[1,2]}')
    )
    return structured_events(
        table(spark, sf_dir, "events"),
        OPTIONS,
        stream=F.lit("all"),
        idx=e,
        source_file=source_file(),
        auto=auto,
        user=user,
    )
