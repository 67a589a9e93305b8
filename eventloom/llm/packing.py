"""Packing documents into training sequences by shortest-pack-first over the length histogram.

Only the histogram (at most one row per length) comes to the driver. Patterns go back to the pieces by
rank within their length; ranks are offsets per (task, length) plus the piece's number in its task, so no
length, however frequent, meets in one task, and token ids are never shuffled.
"""

from __future__ import annotations

import functools
import heapq
import os
import zlib
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count as count_up

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventloom.llm.frames import join_small, settle
from eventloom.llm.words import buffer_of, lower_ascii, slices, span_hashes, word_spans

LENGTH = 2048
END_ID = 1
CACHED_WORDS = 500_000
SLICE = 1 << 20  # bytes of text encoded at once
ROWS = 256  # pieces handled at once when they are placed: at most 2 MB of ids
PIECE = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, part bigint, nth bigint, ids array<int>"


class WordTokenizer:
    """Token ids of whole texts, encoding each different word (by ASCII white space) once.

    For tokenizers that lower the case, drop white space, never join or change words across it, and take
    a full stop or comma after a letter as a token of its own. Words are kept by their 64-bit hash, in
    sorted arrays: a known word costs about 40 bytes.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        suffix, vocabulary = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.is_last = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self.is_last[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.keys, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Adds words with their hashes, none of them known yet.

        Words of ASCII letters, each one word to the tokenizer too, are encoded many in one text if its
        vocabulary marks the ends of words.
        """
        plain = np.fromiter((w.isascii() and w.isalpha() for w in words), bool, len(words)) & self.is_last.any()
        order = np.argsort(~plain, kind="stable")
        sizes, flat = [np.zeros(0, np.int64)], array("i")
        for at in range(0, len(words), 1_000):
            some = [words[i] for i in order[at : at + 1_000].tolist()]
            joined = plain[order[at : at + 1_000]].all()
            codes = self.tokenizer.encode_batch_fast([" ".join(some)] if joined else some, add_special_tokens=False)
            before = len(flat)
            for code in codes:
                flat.extend(code.ids)
            if joined:
                last = np.flatnonzero(self.is_last[np.array(flat[before:], np.int64)])
                sizes.append(np.diff(last, prepend=-1))
            else:
                sizes.append(np.array([len(code) for code in codes], np.int64))
        new = np.concatenate(sizes)
        both = np.concatenate([self.keys, keys[order]])
        begins = np.concatenate([self.begins, len(self.flat) + np.cumsum(new) - new])
        order = np.argsort(both, kind="stable")
        self.keys, self.begins, self.sizes = both[order], begins[order], np.concatenate([self.sizes, new])[order]
        self.flat = np.concatenate([self.flat, np.frombuffer(flat, np.int32)])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, END_ID after each, and the n + 1 offsets of the texts."""
        data, offsets = buffer_of(column)
        raw = data.tobytes()
        if b"<|" not in raw:  # a special token is one in its own case only
            data = lower_ascii(data)
            raw = data.tobytes()
        starts, ends, _ = word_spans(data, offsets)
        last, before = data[ends - 1], data[np.maximum(ends - 2, 0)]
        stop = ((last == 44) | (last == 46)) & (ends - starts > 1) & (before >= 97) & (before <= 122)
        marks = ends[stop] - 1
        starts = np.sort(np.concatenate([starts, marks]), kind="stable")
        ends = np.sort(np.concatenate([ends, marks]), kind="stable")
        firsts = np.searchsorted(starts, offsets)
        hashes, where, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > CACHED_WORDS:
            self._forget()
        new = np.ones(len(hashes), bool)
        if len(self.keys):
            new = self.keys[np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)] != hashes
        if new.any():
            spans = zip(starts[where[new]].tolist(), ends[where[new]].tolist())
            self._learn(hashes[new], [raw[a:z].decode("utf-8", "replace") for a, z in spans])
        spot = np.searchsorted(self.keys, hashes)
        begins, each = self.begins[spot], self.sizes[spot][which]
        out_ends = np.cumsum(each)
        index = np.arange(int(out_ends[-1]) if len(out_ends) else 0) + np.repeat(begins[which] - (out_ends - each), each)
        bounds = np.r_[0, out_ends][firsts]
        ids = np.insert(self.flat[index], bounds[1:], END_ID)
        return ids, bounds + np.arange(len(bounds))


@functools.cache
def _tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so that the tasks it runs share the known words."""
    return WordTokenizer(path)


def _cut(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        part, seen = TaskContext.get().partitionId(), np.zeros(length + 1, np.int64)
        for batch in (piece for batch in batches for piece in slices(batch, "text", SLICE)):
            ids, bounds = tokenizer.encode(batch.column("text"))
            totals = np.diff(bounds)
            pieces = -(-totals // length)
            doc = np.repeat(np.arange(len(totals)), pieces)
            nth_piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = nth_piece * length
            size = np.minimum(totals[doc] - start, length)
            order = np.argsort(size, kind="stable")
            ordered = size[order]
            nth = np.empty(len(size), np.int64)
            nth[order] = np.arange(len(size)) - np.searchsorted(ordered, ordered) + seen[ordered]
            seen += np.bincount(size, minlength=length + 1)
            lists = pa.ListArray.from_arrays(
                pa.array(np.r_[bounds[doc] + start, bounds[-1]].astype(np.int32)), pa.array(ids.astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(size), pa.array(totals[doc]),
                    pa.array(np.full(len(doc), part, np.int64)), pa.array(nth), lists,
                ],
                ["doc_id", "start", "length", "doc_tokens", "part", "nth", "ids"],
            )

    return run


def pack_histogram(histogram: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths in order) and how often each is used, for a histogram of piece lengths.

    Lengths are placed longest first, each onto the pack with the least in it, as many packs of one
    pattern at once as there are pieces. Pieces that fit nowhere open new packs, as many of them in each as fit.
    """
    heap: list[tuple[int, int, tuple[int, ...], int]] = []  # tokens, order of making, pattern, count
    order = count_up()
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left and heap and heap[0][0] + size <= length:
            tokens, _, pattern, count = heapq.heappop(heap)
            used = min(count, left)
            if used < count:
                heapq.heappush(heap, (tokens, next(order), pattern, count - used))
            heapq.heappush(heap, (tokens + size, next(order), pattern + (size,), used))
            left -= used
        each = length // size
        for many, count in ((each, left // each), (left % each, 1)):
            if many and count:
                heapq.heappush(heap, (many * size, next(order), (size,) * many, count))
    return [(pattern, count) for _, _, pattern, count in heap]


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first rank, first sequence and offset of each run of equal slots."""
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, count in patterns:
        offset = 0
        for size in pattern:
            runs[size].append((used[size], sequence, offset))
            used[size] += count
            offset += size
        sequence += count
    return {size: tuple(np.array(c, np.int64) for c in zip(*rows)) for size, rows in runs.items()}


def _assign(places: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], then: Callable | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, len(b), ROWS)):
            sizes, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                first, begin, shift = places[size]
                slot = np.searchsorted(first, ranks[at], "right") - 1
                sequence[at], offset[at] = begin[slot] + ranks[at] - first[slot], shift[slot]
            keep = ["doc_id", "start", "length", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"]
            )

    return run if then is None else lambda batches: then(run(batches))


PLACED = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids array<int>, sequence_id bigint, offset bigint"


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, then: Callable | None = None, schema: str = PLACED) -> DataFrame:
    """Pieces of documents with their place: doc_id, start, length, doc_tokens, ids, sequence_id, offset.

    A null or empty text is one piece holding the end id; repeated rows are packed each on their own;
    an empty table gives no rows. Ids are stored once in the shared folder, then only joined with the
    per-task offsets, which are broadcast if few. `then` may turn the batches of the result into others, of `schema`,
    in the same task.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = settle(docs.mapInArrow(_cut(tokenizer, length), PIECE), "pieces")
    counts = settle(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = settle(
        counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base")), "piece-offsets"
    )
    ranked = join_small(pieces, offsets, ["part", "length"], "inner").withColumn("rank", F.col("base") + F.col("nth"))
    places = _places(pack_histogram(histogram, length))
    return ranked.drop("part", "base", "nth").mapInArrow(_assign(places, then), schema)


def crc_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces `ids` by ids_crc32, the CRC-32 of the ids as little-endian unsigned 32-bit numbers."""
    for batch in (b.slice(at, ROWS) for b in batches for at in range(0, len(b), ROWS)):
        lists = batch.column("ids")
        bounds, flat = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy().astype("<u4")
        sums = [zlib.crc32(flat[a:z].tobytes()) for a, z in zip(bounds[:-1], bounds[1:])]
        keep = [c for c in batch.schema.names if c != "ids"]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(sums, pa.int64())], [*keep, "ids_crc32"])
