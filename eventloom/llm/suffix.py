"""Repeated byte strings by a difference-cover suffix sort, bounded to the length that matters.

A difference cover D modulo v holds, for every two positions i and j, a shift d < v that puts both i + d
and j + d into the sample {p : p mod v in D}. So where two strings of `length` bytes are equal, two sampled
suffixes agree in their first length - v + 1 bytes. The stages:

1. Sample: sampled suffixes are sorted by (a name of) their first length - v + 1 bytes; suffixes whose
   name no neighbour shares drop out. Most do: about |D| / v of all positions were sampled to begin with.
2. Recurse on names: only positions that have a surviving sampled suffix in reach are named again, now by
   their first `length` bytes.
3. Merge and compare: those suffixes are sorted by the long names; equal neighbours begin a repeated string.

Where strings of two lengths are asked for, the longer ones need no sample of their own: all shorter strings of a
repeated longer one are repeated, so it begins where the positions of step 2 go on without a gap. Both are named there.

Names are 64-bit fingerprints within a bucket that a second fingerprint chooses, so sorting by name needs
no bytes of the text. A task's own repeats of a name are settled in the task and sent on once: a passage
that a third of all documents hold is, after that, one entry per task and name.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.frames import join_small, settle
from eventloom.llm.words import buffer_of, slices, span_hashes

LENGTH = 400
# Passages of more than 50 words: such windows of the given texts have 246 bytes or more in 95 % of documents
# (the shortest window of each; English, the shortest language), so 240 bytes lie in nearly all of them.
PASSAGE_BYTES = 240
COVER_ORDER = 11  # v = 11^2 + 11 + 1 = 133 for strings of 400 bytes
BUCKET_BYTES = 8 << 20  # text per bucket of names
SLICE = 2 << 20
BLOB = "bucket int, done boolean, docs binary, counts binary, positions binary, names binary"


@functools.cache
def difference_cover(order: int) -> tuple[int, tuple[int, ...]]:
    """(v, D) with v = order^2 + order + 1 and order + 1 elements, for a prime order (Singer).

    D holds the exponents of a cubic field extension's generator that lie in a plane.
    """
    v = order * order + order + 1
    for c0 in range(1, order):
        for c1 in range(order):
            for c2 in range(order):
                power, found = (1, 0, 0), []
                for exponent in range(v):
                    if power[2] == 0:
                        found.append(exponent)
                    a, b, c = power
                    power = (c * c0 % order, (a + c * c1) % order, (b + c * c2) % order)
                if len(found) == order + 1 and len({(a - b) % v for a in found for b in found}) == v:
                    return v, tuple(found)
    raise ValueError(f"no difference cover of order {order}; it must be a prime")


def _order_for(length: int) -> int:
    """The largest prime order up to COVER_ORDER whose v leaves at least half of `length` to compare."""
    fitting = [q for q in (2, 3, 5, 7, 11) if q <= COVER_ORDER and q * q + q + 1 <= (length + 1) // 2]
    if not fitting:
        raise ValueError("strings must be at least 13 bytes long")
    return fitting[-1]


def _squeeze(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed: the high bytes of near values are alike."""
    import zstandard

    width = values.dtype.itemsize
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _spread(blob: bytes, kind: type) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(planes.reshape(width, -1).T).reshape(-1).view(kind)


def _by_document(doc: np.ndarray, position: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Packed (document, position) pairs that are grouped by document."""
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    counts = np.diff(np.r_[first, len(doc)])
    return _squeeze(doc[first]), _squeeze(counts.astype(np.uint32)), _squeeze(position.astype(np.uint32))


def _pairs(docs: bytes, counts: bytes, positions: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.repeat(_spread(docs, np.int64), _spread(counts, np.uint32).astype(np.int64)), _spread(positions, np.uint32)


def _repeated(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether another entry has the same name, whether it is the first of its name), in input order."""
    order = np.argsort(names, kind="stable")
    ordered = names[order]
    same = ordered[1:] == ordered[:-1]
    twice, first = np.zeros(len(names), bool), np.ones(len(names), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    first[order[1:]] = ~same
    return twice, first


def _emit(doc: np.ndarray, position: np.ndarray, names: np.ndarray, high: np.ndarray, buckets: int, width: int) -> Iterator[tuple]:
    """Rows of BLOB: entries known to repeat (done), and one entry per whole name, of which its bucket gets the top `width` bytes."""
    if not len(doc):
        return
    twice, first = _repeated(names)
    low = names >> np.uint64(64 - 8 * width)
    bucket = (high % np.uint64(buckets)).astype(np.int32)
    for done, keep in ((True, twice), (False, first)):
        at = np.flatnonzero(keep)
        if done:  # dealt out by document
            where = _home(doc[at], buckets)
        else:
            where = bucket[at]
        order = np.argsort(where, kind="stable")
        at, where = at[order], where[order]
        edges = np.flatnonzero(np.r_[True, where[1:] != where[:-1], True]) if len(at) else []
        for a, z in zip(edges[:-1], edges[1:]):
            some = at[a:z]
            packed = b"" if done else low[some].view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
            yield (int(where[a]), done, *_by_document(doc[some], position[some]), packed)


def _rows(entries: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "done", "docs", "counts", "positions", "names"]
    for entry in entries:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(entry, kinds)], names)


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data, offsets = buffer_of(batch.column("text"))
    return batch.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64), data, offsets


def _sample(length: int, buckets: int):
    v, cover = difference_cover(_order_for(length))
    short, pattern = length - v + 1, np.array(cover)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for batch in batches for piece in slices(batch, "text", SLICE)):
            ids, data, offsets = _texts(batch)
            sizes = np.diff(offsets)
            periods = np.where(sizes >= length, -(-sizes // v), 0)
            row = np.repeat(np.arange(len(sizes)), periods)
            begin = (np.arange(len(row)) - np.repeat(np.cumsum(periods) - periods, periods)) * v
            position = (begin[:, None] + pattern).ravel()
            row = np.repeat(row, len(pattern))
            inside = position + short <= sizes[row]
            row, position = row[inside], position[inside]
            starts = offsets[row] + position
            names = span_hashes(data, starts, starts + short)
            # The bucket takes low bits, the stored name the high ones: together they are the fingerprint.
            yield from _rows(_emit(ids[row], position, names, names, buckets, 4))

    return run


def _home(doc: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket that gathers a document's positions."""
    return ((doc.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)


def _join_names(width: int, buckets: int):
    """Per bucket: entries whose name another task has too, and what tasks have settled, packed by home bucket."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        docs, positions, names, out_docs, out_positions = [], [], [], [], []
        for done, d, c, p, n in zip(frame["done"], frame["docs"], frame["counts"], frame["positions"], frame["names"]):
            doc, position = _pairs(d, c, p)
            if done:
                out_docs.append(doc)
                out_positions.append(position)
            else:
                docs.append(doc)
                positions.append(position)
                wide = np.zeros((len(doc), 8), np.uint8)
                wide[:, :width] = np.frombuffer(n, np.uint8).reshape(-1, width)
                names.append(wide.reshape(-1).view(np.uint64))
        if names:
            twice, _ = _repeated(np.concatenate(names))
            out_docs.append(np.concatenate(docs)[twice])
            out_positions.append(np.concatenate(positions)[twice])
        doc, position = np.concatenate(out_docs), np.concatenate(out_positions)
        home = _home(doc, buckets) + np.int32(buckets if frame["bucket"].iloc[0] >= buckets else 0)
        order = np.lexsort((position, doc, home))
        doc, position, home = doc[order], position[order], home[order]
        edges = np.flatnonzero(np.r_[True, home[1:] != home[:-1], True]) if len(doc) else np.zeros(1, int)
        rows = [(int(home[a]), *_by_document(doc[a:z], position[a:z])) for a, z in zip(edges[:-1], edges[1:])]
        return pd.DataFrame(rows, columns=["home", "docs", "counts", "positions"])

    return run


def _gather(frame: pd.DataFrame) -> pd.DataFrame:
    """All positions of each document of a home bucket, of one length."""
    pairs = [_pairs(d, c, p) for d, c, p in zip(frame["docs"], frame["counts"], frame["positions"])]
    doc, position = (np.concatenate(x) for x in zip(*pairs))
    order = np.lexsort((position, doc))
    doc, position = doc[order], position[order]
    edges = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1], True])
    found = [[_squeeze(np.unique(position[a:z]))] for a, z in zip(edges[:-1], edges[1:])]
    return pd.DataFrame({"doc_id": doc[edges[:-1]], "found": found, "home": int(frame["home"].iloc[0])})


def _positions(found: list | None) -> np.ndarray:
    return np.unique(np.concatenate([_spread(b, np.uint32) for b in found])).astype(np.int64) if found else np.zeros(0, np.int64)


def _reach(survivors: np.ndarray, size: int, v: int, length: int) -> np.ndarray:
    """Starts of strings of `length` bytes that have a surviving sampled suffix among their first v positions."""
    marks = np.zeros(size + 1, np.int32)
    np.add.at(marks, np.maximum(survivors - v + 1, 0), 1)
    np.add.at(marks, survivors + 1, -1)
    return np.flatnonzero(np.cumsum(marks)[: max(size - length + 1, 0)])


def _runs(starts: np.ndarray, more: int) -> np.ndarray:
    """Those starts that the next `more` positions follow without a gap."""
    return starts[: max(len(starts) - more, 0)][starts[more:] - starts[: max(len(starts) - more, 0)] == more]


def _name_again(length: int, buckets: int, longer: int | None = None):
    """Names of strings that may repeat. Those of `longer` bytes, if asked for, have buckets of their own: from `buckets` on."""
    v, _ = difference_cover(_order_for(length))

    def names_of(ids, data, offsets, starts, size: int) -> Iterator[tuple]:
        row = np.repeat(np.arange(len(starts)), [len(x) for x in starts])
        position = np.concatenate(starts)
        begin = offsets[row] + position
        names = span_hashes(data, begin, begin + size, 2)
        high = span_hashes(data, begin, begin + size, 3)
        return _emit(ids[row], position, names, high, buckets, 8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for batch in batches for piece in slices(batch, "text", SLICE)):
            ids, data, offsets = _texts(batch)
            found = batch.column("found").to_pylist()
            starts = [_reach(_positions(found[i]), size, v, length) for i, size in enumerate(np.diff(offsets).tolist())]
            yield from _rows(names_of(ids, data, offsets, starts, length))
            if longer:
                starts = [_runs(x, longer - length) for x in starts]
                yield from _rows((b + buckets, *rest) for b, *rest in names_of(ids, data, offsets, starts, longer))

    return run


def _spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for found in batch.column("found").to_pylist():
                at = _positions(found)
                cut = np.flatnonzero(np.diff(at) > length)
                starts, ends = at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]] + length
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(starts, ends)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, kind)], ["doc_id", "spans"])

    return run


def _matches(texts: DataFrame, name: Callable, buckets: int, width: int, label: str) -> DataFrame:
    blobs = texts.mapInArrow(name, BLOB).repartition(F.col("bucket"))
    packed = blobs.groupBy("bucket").applyInPandas(
        _join_names(width, buckets), "home int, docs binary, counts binary, positions binary"
    )
    gathered = packed.groupBy("home").applyInPandas(_gather, "doc_id bigint, found array<binary>, home int")
    return settle(gathered.select("doc_id", "found", (F.col("home") >= buckets).alias("longer")), label)


def _long_texts(docs: DataFrame, length: int) -> DataFrame:
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length))


def _copies(texts: DataFrame) -> DataFrame:
    """Documents whose text another one has too: doc_id, the group's first doc_id, size in bytes."""
    digests = texts.select("doc_id", F.md5("text").alias("digest"), F.octet_length("text").cast("bigint").alias("size"))
    groups = digests.groupBy("digest", "size").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    return settle(
        digests.join(groups.where("n > 1"), ["digest", "size"])
        .groupBy("doc_id")
        .agg(F.min("first").alias("first"), F.max("size").alias("size")),
        "copies",
    )


def _bucket_count(texts: DataFrame) -> int:
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_BYTES))


def _starts(single: DataFrame, length: int, buckets: int, longer: int | None = None) -> DataFrame:
    """doc_id and packed starts (found) of repeated strings of `length` bytes; a row of its own (longer) for those of `longer`."""
    survivors = _matches(single, _sample(length, buckets), buckets, 4, "sampled-suffixes").drop("longer")
    near = join_small(single, survivors, "doc_id", "inner", 200_000)
    return _matches(near, _name_again(length, buckets, longer), buckets, 8, "repeated-starts")


def _merged(starts: DataFrame, copies: DataFrame, length: int) -> DataFrame:
    """doc_id and spans, with all bytes of documents that have copies."""
    spans = starts.mapInArrow(_spans(length), "doc_id bigint, spans array<struct<start:bigint,end:bigint>>")
    long = copies.where(F.col("size") >= length)
    whole = long.select("doc_id", F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("size").alias("end"))).alias("spans"))
    return spans.join(long.select("doc_id"), "doc_id", "left_anti").unionByName(whole)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id and spans (start, end in bytes, merged) of bytes inside a repeated string of `length` bytes.

    Only documents with such bytes have a row. A string repeats if it also starts anywhere else, in the
    same document too. Documents of equal text are settled by one digest join: all of their bytes are
    repeated, and one of them stands for the group in the search. doc_id is the key; a row repeated
    under its id counts as one more copy. Null ids are left out.
    """
    texts = _long_texts(docs, length)
    copies = _copies(texts)
    single = join_small(texts, copies.where("doc_id <> first").select("doc_id"), "doc_id", "left_anti")
    return settle(_merged(_starts(single, length, _bucket_count(texts)), copies, length), "repeated-spans")


def repeated_spans_of_two(docs: DataFrame, short: int, length: int) -> DataFrame:
    """repeated_spans of both lengths in one search: doc_id, spans (of `length`, null if none) and passages (of `short`)."""
    texts = _long_texts(docs, short)
    copies, buckets = _copies(texts), _bucket_count(texts)
    single = join_small(texts, copies.where("doc_id <> first").select("doc_id"), "doc_id", "left_anti")
    starts = _starts(single, short, buckets, length)
    spans = _merged(starts.where("longer"), copies, length)
    passages = _merged(starts.where("not longer"), copies, short).withColumnRenamed("spans", "passages")
    return settle(passages.join(spans, "doc_id", "left").select("doc_id", "spans", "passages"), "repeated-spans")


def _without(data: bytes, spans: list[dict] | None) -> bytes:
    at, parts = 0, []
    for span in spans or ():
        parts.append(data[at : span["start"]])
        at = span["end"]
    return b"".join([*parts, data[at:]])


def _whole_characters(data: bytes, spans: list[dict]) -> list[dict]:
    """Spans of UTF-8 bytes narrowed to the characters wholly inside them."""
    narrow = []
    for start, end in ((s["start"], s["end"]) for s in spans):
        while start < len(data) and data[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
            end -= 1
        narrow.append({"start": start, "end": max(end, start)})
    return narrow


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for batch in batches for piece in slices(batch, "text", SLICE)):
        texts = [(text or "").encode() for text in batch.column("text").to_pylist()]
        kept = [_without(data, spans) for data, spans in zip(texts, batch.column("spans").to_pylist())]
        out = batch.drop_columns("text").append_column("kept", pa.array(kept, pa.binary()))
        if "passages" in batch.schema.names:
            clean = [_without(d, _whole_characters(d, p or [])) for d, p in zip(texts, batch.column("passages").to_pylist())]
            gone = [len(data) - len(left) for data, left in zip(texts, clean)]
            out = out.drop_columns("passages").append_column("n_passage_bytes", pa.array(gone, pa.int64()))
            out = out.append_column("text", pa.array([left.decode() for left in clean], pa.string()))
        yield out


def remove_repeats(docs: DataFrame, length: int = LENGTH, passage: int | None = None) -> DataFrame:
    """Every row of docs as doc_id, spans (empty if none), n_bytes and kept, the remaining bytes.

    A null or empty text keeps nothing and loses nothing. Bytes are cut wherever spans end, also inside
    a character. With `passage`, a length under `length`, two columns follow: text, from which repeated strings
    of that many bytes are cut, whole characters only, and n_passage_bytes, the bytes cut from it.
    """
    spans = repeated_spans(docs, length) if passage is None else repeated_spans_of_two(docs, passage, length)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    kind, schema = "array<struct<start:bigint,end:bigint>>", "doc_id bigint, spans array<struct<start:bigint,end:bigint>>, n_bytes bigint, kept binary"
    rows = join_small(rows, spans, "doc_id", "left", 500_000 if passage is None else 250_000).select(
        "doc_id", "text", F.coalesce("spans", F.array().cast(kind)).alias("spans"),
        F.octet_length("text").cast("bigint").alias("n_bytes"), *(["passages"] if passage else []),
    )
    return rows.mapInArrow(_cut, schema + (", n_passage_bytes bigint, text string" if passage else ""))


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for batch in batches for piece in slices(batch, "text", SLICE)):
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            if spans:
                data = text.encode()
                text = _without(data, _whole_characters(data, spans)).decode()
            texts.append(text)
        columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in batch.schema.names if n != "spans"]
        yield pa.RecordBatch.from_arrays(columns, [n for n in batch.schema.names if n != "spans"])


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with the repeated strings cut out of `text`, whole characters only; all rows and columns stay."""
    spans = repeated_spans(docs, length)
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "spans")]
    rows = docs.select("doc_id", "text", *rest)
    return join_small(rows, spans, "doc_id", "left", 500_000).mapInArrow(_clean, rows.schema)
