"""Recognise single-file archives by their first bytes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.schema import ARCHIVE_MAGIC


def is_archive(content: Column) -> Column:
    """True where bytes start with the archive magic; false, not null, where they are shorter."""
    return F.substring(content, 1, len(ARCHIVE_MAGIC)) == F.lit(ARCHIVE_MAGIC)


def read_heads(
    files: DataFrame,
    n_bytes: int = len(ARCHIVE_MAGIC),
    opener: Callable[[str], BinaryIO] | None = None,
) -> DataFrame:
    """(path, length, head): the first bytes of every file of a table (path, length).

    Each task opens its files and reads n_bytes of each; empty files are not opened. The built-in binary
    source would load whole files for the content column. `opener` opens what neither local paths nor
    pyarrow's filesystems cover.
    """

    # Everything the tasks need is inside, so executors need pyarrow but not this package.
    def open_file(name: str) -> pa.NativeFile:
        if opener is not None:
            return opener(name)
        scheme, _, rest = name.partition(":")
        if scheme in ("s3a", "s3n"):  # Spark's names for what pyarrow calls s3
            name = f"s3:{rest}"
        if scheme == "file":
            return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
        filesystem, inside = fs.FileSystem.from_uri(quote(name, safe=":/@"))
        return filesystem.open_input_file(inside)

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for name, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                if length == 0:
                    found.append(b"")
                    continue
                with open_file(name) as file:
                    found.append(file.read(n_bytes))
            columns = [batch.column("path"), batch.column("length"), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["path", "length", "head"])

    return files.select("path", F.col("length").cast("bigint").alias("length")).mapInArrow(
        heads, "path string, length bigint, head binary"
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files under a path; Spark's listing leaves out empty files."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    ).select("path", "length")


def classify_listed(files: DataFrame, opener: Callable[[str], BinaryIO] | None = None) -> DataFrame:
    """(path, length, is_archive) for a table (path, length) of files, empty ones included."""
    return read_heads(files, opener=opener).select("path", "length", is_archive(F.col("head")).alias("is_archive"))


def classify_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, is_archive) for the non-empty files under a path."""
    return classify_listed(list_files(spark, path))
