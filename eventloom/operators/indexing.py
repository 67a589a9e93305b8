"""Give every event its 0-based position in its stream, once, at load time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators.chunks import (
    BROADCAST_ROWS,
    CHUNK_BITS,
    broadcast_if_small,
    carry_before,
    required,
)
from eventloom.schema import IDX, STREAM
from eventloom.session import settle


def part_number(path: Column) -> Column:
    """The number in a part file's name, null for other names: as text, part-100000 comes before part-99999."""
    return F.regexp_extract(path, r"part-(\d+)[^/]*$", 1).try_cast("bigint")


def index_by_order(
    rows: DataFrame, order: str, stream: str = STREAM, bits: int = CHUNK_BITS, name: str = IDX
) -> DataFrame:
    """Dense positions per stream in the order of a BIGINT column that is unique within a stream.

    One shuffle of the rows, on (stream, order >> bits); the offsets come from a count per chunk.
    """
    cut = rows.withColumn(stream, required(F.col(stream), stream)).withColumn(
        "_chunk", F.shiftright(required(F.col(order), order), bits)
    )
    counts = settle(cut.groupBy(stream, "_chunk").agg(F.count("*").alias("_n")), "chunk-counts")
    offsets = carry_before(counts, [stream], "_chunk", "_n", "sum", "_before").drop("_n")
    within = Window.partitionBy(stream, "_chunk").orderBy(order)
    return (
        cut.withColumn("_place", F.row_number().over(within))
        .join(offsets, [stream, "_chunk"])
        .withColumn(name, F.col("_before") + F.col("_place") - 1)
        .drop("_chunk", "_place", "_before")
    )


def index_by_rank(
    rows: DataFrame, order: Sequence[str], stream: str = STREAM, name: str = IDX, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Dense positions per stream in the order of any columns that are unique together within a stream.

    For orders with gaps of any size, or of any type: nanoseconds, texts, several columns. The rows are range
    partitioned by (stream, order), with splitters that Spark samples, sorted, and written once to the shared folder;
    a row's position is its place in its range plus the rows of its stream in earlier ranges. The summary has one
    row per range and stream in it, and is carried in two levels where it is long. A repeated order, or a null in
    it, raises. Order columns are compared as Spark sorts them, texts bytewise.
    """
    keys = [stream, *order]
    checked = rows.withColumns({key: required(F.col(key), key) for key in keys})
    again = checked.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if again:
        raise ValueError(f"order is not unique: {again[0].asDict()}")
    ranged = checked.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    ranged = settle(ranged, "ranked-rows").withColumns(
        {"_range": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND((1 << 33) - 1)}
    )
    counts = ranged.groupBy(stream, "_range").agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    before = carry_before(settle(counts, "range-counts"), [stream], "_range", "_n", "sum", "_before", flat_rows=broadcast_rows)
    return (
        ranged.join(broadcast_if_small(before.drop("_n"), broadcast_rows), [stream, "_range"])
        .withColumn(name, F.col("_before") + F.col("_row") - F.col("_first"))
        .drop("_at", "_range", "_row", "_first", "_before")
    )


def index_by_ordinal_files(
    rows: DataFrame,
    file_ordinal: str,
    position: str,
    stream: str = STREAM,
    bits: int = CHUNK_BITS,
    name: str = IDX,
) -> DataFrame:
    """Dense positions from a BIGINT file number and a dense 0-based position inside the file.

    The rows are not shuffled if the offsets (one row per file) are small enough to broadcast.
    """
    rows = rows.withColumns(
        {stream: required(F.col(stream), stream), file_ordinal: required(F.col(file_ordinal), file_ordinal)}
    )
    counts = settle(rows.groupBy(stream, file_ordinal).agg(F.count("*").alias("_n")), "file-counts")
    counts = counts.withColumn("_chunk", F.shiftright(F.col(file_ordinal), bits))
    per_chunk = counts.groupBy(stream, "_chunk").agg(F.sum("_n").alias("_n"))
    before = carry_before(per_chunk, [stream], "_chunk", "_n", "sum", "_before").drop("_n")
    within = (
        Window.partitionBy(stream, "_chunk")
        .orderBy(file_ordinal)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        counts.withColumn("_inner", F.coalesce(F.sum("_n").over(within), F.lit(0)))
        .join(before, [stream, "_chunk"])
        .select(stream, file_ordinal, (F.col("_before") + F.col("_inner")).alias("_offset"))
    )
    return (
        rows.join(broadcast_if_small(offsets), [stream, file_ordinal])
        .withColumn(name, F.col("_offset") + F.col(position))
        .drop("_offset")
    )


def index_by_parquet_position(
    rows: DataFrame,
    stream: Column | None = None,
    name: str = IDX,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Positions in file order, straight from a parquet scan: row number in file + rows before it.

    The row counts come from the files' footers (no column is read), and a file's rows keep their
    numbers whichever executor reads them, so a lost executor cannot change an index. `stream` must
    be constant per file; without it the whole scan is one stream. The window over files sees one
    row per file, the same list the driver holds to plan the scan.
    """
    key = F.lit("all") if stream is None else stream
    located = rows.select(
        "*",
        required(key.cast("string"), "stream").alias("_stream"),
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.row_index").alias("_row"),
    )
    counts = settle(
        located.groupBy("_stream", "_path").agg(F.count("*").alias("_n")), "file-counts"
    )
    in_file_order = [F.regexp_replace("_path", "[^/]*$", ""), part_number(F.col("_path")), "_path"]
    earlier = Window.partitionBy("_stream").orderBy(*in_file_order).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_stream", "_path", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        located.join(broadcast_if_small(offsets, broadcast_rows), ["_stream", "_path"])
        .withColumn(name, F.col("_offset") + F.col("_row"))
        .drop("_stream", "_path", "_row", "_offset")
    )


def index_by_line(lines: DataFrame, staged_at: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Positions for text lines, per file: adds source path, and the line's number in its file.

    Text has no row numbers, and how Spark cuts files into tasks may change between two jobs, so the
    lines are first written once with their place in the cut (to a folder on shared storage) and
    everything after that is computed from the written copy.
    """
    spark = lines.sparkSession
    lines.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    ).write.parquet(staged_at)
    staged = spark.read.parquet(staged_at)
    blocks = settle(
        staged.groupBy("_path", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first")),
        "block-counts",
    )
    earlier = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        "_path", "_block", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    return (
        staged.join(broadcast_if_small(starts, broadcast_rows), ["_path", "_block"])
        .withColumn("line_number", F.col("_before") + F.col("_at") - F.col("_first"))
        .withColumnRenamed("_path", "source_path")
        .drop("_block", "_at", "_first", "_before")
    )


def event_number(idx: Column) -> Column:
    """1-based number of an event in its whole stream."""
    return idx + 1
