"""WARC archives with revisit records, and their index merged into capture histories.

Every record is a gzip member of its own, so the index names places in the file and a record is fetched by its
bytes alone. The members are made in the tasks and written by Spark's text writer, so archives go to any store Spark
writes to and a lost task is simply written again. The writer ends every value with a byte of our choice: that
is the zero a member ends with (the top byte of its length; after a record of 16 MB or more comes an empty
member). Archives are cut at FILE_BYTES, and each is one sorted run of captures. The index of all runs is
dealt by ranges of (URL key, time, page), so a hot URL spreads over tasks; each task merges its runs with a loser
tree. A task holds the index rows of its range, not the pages; a reader holds one archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.frames import join_small, settle

FILE_BYTES = 64 << 20  # of an archive, compressed; a longer record has an archive of its own
BATCH_BYTES = 8 << 20
_EMPTY = gzip.compress(b"", mtime=0)
_STEP = 1 << 16
_CRLF = "\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed values: RFC 4648
INDEX = "urlkey string, captured_at string, page_id bigint, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint, archive string, offset bigint, length bigint"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary or string column."""
    digits = F.sha1(data)
    five = lambda g: F.conv(F.substring(digits, 1 + 10 * g, 10), 16, 10).cast("bigint")
    letter = lambda value, k: F.substring(F.lit(_BASE32), (F.shiftright(value, 35 - 5 * k).bitwiseAND(31) + 1).cast("int"), F.lit(1))
    return F.concat(*[letter(five(g), k) for g in range(4) for k in range(8)])


def url_key(url: Column) -> Column:
    """Host labels reversed, then port, path and query, in lower case: `org,example)/a?b`."""
    url = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(url, r"^[a-z][a-z0-9+.-]*://([^/:?#]*)", 1)
    rest = F.regexp_replace(url, r"^[a-z][a-z0-9+.-]*://[^/:?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def _members(batches: Iterator[pa.RecordBatch], file_bytes: int) -> Iterator[pa.RecordBatch]:
    """Each record as a gzip member without its last byte (a zero), under the number of its archive in the task."""
    part = used = held = 0
    out: list[list] = [[] for _ in range(5)]
    kinds = [pa.int32(), pa.string(), pa.string(), pa.int64(), pa.binary()]
    names = ["part", "urlkey", "captured_at", "page_id", "member"]
    for batch in batches:
        records = batch.column(3)
        for i in range(batch.num_rows):
            packer = zlib.compressobj(6, zlib.DEFLATED, 31)
            member = packer.compress(memoryview(records[i].as_buffer())) + packer.flush()
            if member[-1]:
                member += _EMPTY
            if used and used + len(member) > file_bytes:
                part, used = part + 1, 0
            used, held = used + len(member), held + len(member)
            for column, value in zip(out, (part, *(batch.column(k)[i].as_py() for k in range(3)), member[:-1])):
                column.append(value)
            if held > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
                out, held = [[] for _ in range(5)], 0
    if out[0]:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)


def write_archives(pages: DataFrame, path: str, captured_at: Column, revisit_from: int = 0, file_bytes: int = FILE_BYTES) -> None:
    """Write one record per row of (page_id, url, html); a null html is an empty payload.

    Among equal payloads of at least `revisit_from` bytes the smallest page_id is the response and the
    others revisit it; a row repeated under that page_id is a response again. Shorter payloads are all
    responses. A null URL gives a record without target.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), captured_at.alias("captured_at"))
    rows = rows.withColumns({"size": F.octet_length("html"), "digest": base32_sha1(F.col("html"))})
    firsts = settle(
        rows.where(F.col("size") >= revisit_from)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .drop("n"),
        "first-captures",
    )
    rows = join_small(rows, firsts, "digest", "left")
    revisit = (F.col("first") != F.col("page_id")) & (F.col("size") >= revisit_from)
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
        F.col("size").cast("string"),
        F.lit(_CRLF * 2),
    )
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))
    clean = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    record = F.concat(
        F.lit("WARC/1.1" + _CRLF),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Date", F.col("captured_at")),
        F.coalesce(line("WARC-Target-URI", clean), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("X-Payload-Length", F.col("size").cast("string")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))),
            ),
        ).otherwise(F.lit("")),
        F.lit(f"Content-Type: application/http; msgtype=response{_CRLF}"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_CRLF),
        block,
        F.lit(_CRLF * 2),
    )
    order = ["urlkey", "captured_at", "page_id"]
    sorted_rows = rows.withColumn("urlkey", url_key(F.col("url"))).sortWithinPartitions(*order)
    members = sorted_rows.select(*order, record.cast("binary").alias("record")).mapInArrow(
        lambda batches: _members(batches, file_bytes), "part int, urlkey string, captured_at string, page_id bigint, member binary"
    )
    (
        members.sortWithinPartitions("part", *order)
        .select("part", F.col("member").cast("string").alias("value"))
        .write.partitionBy("part")
        .option("lineSep", "\0")
        .text(path)
    )


def _unpacked(data: memoryview) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, record) of each member; an empty member belongs to the one before it."""
    at = 0
    while at < len(data):
        end, inflate, pieces = at, zlib.decompressobj(31), []
        while not inflate.eof:
            piece = data[end : end + _STEP]
            pieces.append(inflate.decompress(piece))
            end += len(piece) - len(inflate.unused_data)
        if data[end : end + len(_EMPTY)] == _EMPTY:
            end += len(_EMPTY)
        yield at, end - at, b"".join(pieces)
        at = end


def _record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, the block by its Content-Length."""
    stream, headers = io.BytesIO(raw), {}
    stream.readline()
    while (line := stream.readline()) not in (b"\r\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        headers[name.lower()] = value.strip()
    return headers, stream.read(int(headers["content-length"]))


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content, urls in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(0)):
            rows = []
            for offset, length, raw in _unpacked(memoryview(content.as_buffer()).cast("B")):
                headers, block = _record(raw)
                payload = block.partition(b"\r\n\r\n")[2]
                kind = headers["warc-type"]
                if kind == "response":
                    size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                else:
                    size = int(headers["x-payload-length"])
                    digest = headers["warc-payload-digest"].removeprefix("sha1:")
                rows.append(
                    (headers.get("warc-target-uri"), headers["warc-date"], _page(headers["warc-record-id"]), kind, size, digest, _page(headers.get("warc-refers-to")), path, offset, length)
                )
            if rows:
                names = ["url", "captured_at", "page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "archive", "offset", "length"]
                kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One index row per record: its place in its archive; size and digest of a response come from its payload."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    rows = files.mapInArrow(_read_batches, "url string, " + INDEX.partition(", ")[2])
    return rows.withColumn("urlkey", url_key(F.col("url"))).drop("url").select(*[c.split()[0] for c in INDEX.split(", ")])


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            headers, block = _record(gzip.decompress(batch.column(1)[i].as_buffer()))
            columns = [batch.column(0).slice(i, 1), pa.array([headers["warc-type"]]), pa.array([block.partition(b"\r\n\r\n")[2]])]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "record_type", "payload"])


def fetch_records(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(page_id, record_type, payload) of the index rows in `wanted`, unpacked from their own bytes only.

    Uses archive, offset, length and page_id. A revisit has an empty payload; fetch the page it refers to.
    """
    places = settle(wanted.select("archive", "offset", "length", "page_id"), "wanted-records")
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("archive"), "content")
    member = F.substring("content", (F.col("offset") + 1).cast("int"), F.col("length").cast("int"))
    picked = join_small(files, places, "archive", "inner").select("page_id", member.alias("member"))
    return picked.mapInArrow(_fetched, "page_id bigint, record_type string, payload binary")


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the root the winner."""

    def __init__(self, runs: list[list[tuple]]) -> None:
        self.runs, self.at, self.k = runs, [0] * len(runs), max(1, len(runs))
        self.losers = [-1] * self.k
        for run in range(len(runs)):
            self._play(run)

    def _before(self, a: int, b: int) -> bool:
        """Whether run a's head comes before run b's; an ended run comes last, ties go to the lower run."""
        if self.at[a] == len(self.runs[a]):
            return False
        if self.at[b] == len(self.runs[b]):
            return True
        x, y = self.runs[a][self.at[a]], self.runs[b][self.at[b]]
        return x < y or (x == y and a < b)

    def _play(self, run: int) -> None:
        node, winner = (run + self.k) // 2, run
        while node > 0:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = winner
                return
            if self._before(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """(run, position in the run), in order."""
        for _ in range(sum(map(len, self.runs))):
            run = self.losers[0]
            yield run, self.at[run]
            self.at[run] += 1
            self._play(run)


def _merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    parts = [f for f in frames if len(f)]
    if not parts:
        return
    rows = pd.concat(parts, ignore_index=True)
    bounds = rows.groupby("archive", sort=False).indices
    keys = list(zip(rows["urlkey"], rows["captured_at"], rows["page_id"].fillna(-1)))
    order_of = [sorted(index) for index in bounds.values()]
    tree = LoserTree([[keys[i] for i in index] for index in order_of])
    order = [order_of[run][at] for run, at in tree]
    merged = rows.iloc[order].reset_index(drop=True)
    merged.insert(0, "position", (TaskContext.get().partitionId() << 40) + merged.index.to_numpy())
    yield merged


def merge_index(index: DataFrame) -> DataFrame:
    """Capture histories in global order: the index rows with `position`, which ascends with (URL key, time, page)."""
    ranged = index.repartitionByRange("urlkey", "captured_at", "page_id")
    runs = ranged.sortWithinPartitions("archive", "urlkey", "captured_at", "page_id")
    return runs.mapInPandas(_merge, "position bigint, " + INDEX)
