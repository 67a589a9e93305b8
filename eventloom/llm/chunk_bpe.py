"""Byte-level BPE of whole texts with chunk reuse: chunks that texts share are encoded once for all of them.

1. Texts are cut where a rolling hash of the last 32 bytes ends in zeros, so equal passages have equal chunks
   wherever they stand. Chunks go by two 64-bit hashes; those found twice or more are shared.
2. A chunk's first and last bytes merge differently in different surroundings, so its joins are repaired: from a
   chunk's encoding only the core is taken, between its first and last point of agreement; what lies between two
   cores is encoded anew in its document. A point of agreement is an end of a word before a white space: no
   pre-token crosses it whatever the surroundings, and pre-tokens after it depend on nothing before it. That the
   encoding of the chunk does break at all of them is checked in bytes; were it not so, the job would stop.
   For the same reason what a document encodes itself is cut at these points, and a task encodes equal pieces once.
3. Documents keep the ids of their own parts and references to shared chunks; only references and the ids of
   documents that have some are shuffled, never texts other than one copy of a shared chunk a task.

Which chunks are shared is told to tasks by a bitmap of fixed size. Where it is full, more chunks than needed are
encoded apart; the result is the same.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.bitmaps import bitmap_of, is_set
from eventloom.llm.frames import settle, settle_packed
from eventloom.llm.words import buffer_of, slices, span_hashes

WINDOW_DOUBLINGS = 5  # a window of 32 bytes
CHUNK_BITS = 9  # chunks of 512 bytes on average
LEAST, MOST = 64, 1 << 16  # sizes of chunks worth and fit to be shared; others are encoded in place
PIECE = 1 << 17
KNOWN, KNOWN_BYTES = 300_000, 8 << 20  # words whose ids a worker keeps, and their bytes
TOGETHER = 1 << 17  # words looked up together
FILTER_BITS = 24  # a bitmap of 2 MB
HOT = 20_000
BLANKS = b" \t\n\r"
CHUNK = "fp bigint, check bigint"
ROW = f"row_id bigint, doc_id bigint, ids binary, gaps binary, refs array<struct<fp:bigint,check:bigint>>, {CHUNK}, chunk string"


@functools.cache
def _gears() -> np.ndarray:
    return np.random.default_rng(13).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling(data: np.ndarray) -> np.ndarray:
    """For every byte a 32-bit hash of the 32 bytes that end with it, of fewer at the start."""
    out = _gears()[data]
    for k in range(WINDOW_DOUBLINGS):
        wide = 1 << k
        if len(out) > wide:
            out[wide:] += out[:-wide] << np.uint32(wide)
    return out


def chunk_starts(data: np.ndarray, offsets: np.ndarray, bits: int = CHUNK_BITS) -> np.ndarray:
    """Where chunks begin: at every text that isn't empty, and after a window whose hash says so, at whole characters."""
    first = offsets[:-1][np.diff(offsets) > 0]
    if not len(data):
        return first
    cut = 1 + np.flatnonzero(rolling(data)[:-1] >> np.uint32(32 - bits) == 0)
    cut = cut[(data[cut] & 0xC0) != 0x80]
    text = offsets[np.searchsorted(offsets, cut, "right") - 1]
    return np.union1d(first, cut[cut - text >= 1 << WINDOW_DOUBLINGS])


def agreements(data: np.ndarray) -> np.ndarray:
    """Positions of a blank, tab or line end right after a printable ASCII byte, or a character of U+00C0 to U+07FF.

    None of these is white space; characters beyond may be.
    """
    space = (data == 32) | (data == 9) | (data == 10) | (data == 13)
    solid = (data > 32) & (data < 127)
    solid[1:] |= (data[:-1] >= 0xC3) & (data[:-1] <= 0xDF)
    return 1 + np.flatnonzero(space[1:] & solid[:-1])


def ends_solid(word: bytes) -> bool:
    """Whether a blank right after the word is a point of agreement."""
    return 32 < word[-1] < 127 or len(word) > 1 and 0xC3 <= word[-2] <= 0xDF


def _chunks(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Bytes and offsets of the texts; start, end, core start and core end of chunks fit to be shared; their hashes."""
    data, offsets = buffer_of(column)
    starts = chunk_starts(data, offsets)
    ends = np.r_[starts[1:], len(data)][: len(starts)]
    points = agreements(data)
    low, high = np.searchsorted(points, starts, "right"), np.searchsorted(points, ends, "left") - 1
    fit = (high > low) & (ends - starts >= LEAST) & (ends - starts <= MOST)
    starts, ends, low, high = starts[fit], ends[fit], points[low[fit]], points[high[fit]]
    return data, offsets, starts, ends, low, high, span_hashes(data, starts, ends, 5), span_hashes(data, starts, ends, 6)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for batch in batches for piece in slices(batch, "text")):
        *_, fp, check = _chunks(batch.column("text"))
        _, where, times = np.unique(fp, return_index=True, return_counts=True)
        columns = [fp[where].view(np.int64), check[where].view(np.int64), times]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fp", "check", "n"])


class Coder:
    """A byte-level tokenizer as it is read, without truncation and padding, and the bytes of its tokens."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Byte-level vocabularies write a byte as the character of its number, or, where that isn't visible, one above 255.
        visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
        hidden = [b for b in range(256) if b not in visible]
        byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        added = {i: t.content.encode() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        vocabulary = {i: t for t, i in self.tokenizer.get_vocab().items()}
        self.bytes = [added.get(i) or bytes(byte[c] for c in vocabulary.get(i, "")) for i in range(max(vocabulary) + 1)]
        self.sizes = np.array([len(b) for b in self.bytes])
        self.decimal = [str(i) for i in range(len(self.bytes))]
        self.kind = np.uint16 if len(self.bytes) <= 1 << 16 else np.uint32
        self._forget()

    def _forget(self) -> None:
        self.known, self.known_bytes = {}, 0  # a piece's place in the two arrays
        self.known_ids, self.known_ends = np.zeros(0, self.kind), np.zeros(1, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each text's ids."""
        flat, sizes, at = [np.zeros(0, self.kind)], [], 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= 1 << 20):
                size, to = size + len(texts[to]), to + 1
            for code in self.tokenizer.encode_batch_fast(texts[at:to], add_special_tokens=False):
                ids = np.array(code.ids, self.kind)
                flat.append(ids)
                sizes.append(len(ids))
            at = to
        return np.concatenate(flat), np.array(sizes, np.int64)

    def encode_joined(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """encode() of words of which each begins with a blank and ends as before a point of agreement."""
        ends = np.cumsum([len(word) for word in words])
        raw = b"".join(words)
        pieces, _ = _pieces(np.zeros(1, np.int64), ends[-1:], ends)
        ids, _ = self.encode([raw[a:z].decode() for a, z in pieces])
        edges = np.cumsum(self.sizes[ids])
        last = np.searchsorted(edges, ends)
        if len(edges) <= last[-1] or (edges[last] != ends).any():
            raise ValueError("a token crosses the end of a word: this tokenizer can't reuse words")
        return ids, np.diff(last + 1, prepend=0)

    def encode_known(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """encode() of what lies between points of agreement, equal words once, also those of earlier calls."""
        if len(self.known) > KNOWN or self.known_bytes > KNOWN_BYTES:
            self._forget()
        joined, single = [], []
        for word in dict.fromkeys(words):
            if word not in self.known:
                (joined if word[0] in BLANKS and ends_solid(word) else single).append(word)
        for new, encode in ((joined, self.encode_joined), (single, lambda some: self.encode([word.decode() for word in some]))):
            if new:
                ids, sizes = encode(new)
                self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
                self.known_bytes += sum(map(len, new))
                self.known_ids = np.concatenate([self.known_ids, ids])
                self.known_ends = np.r_[self.known_ends, self.known_ends[-1] + np.cumsum(sizes)]
        which = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        starts, sizes = self.known_ends[which], np.diff(self.known_ends)[which]
        place = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return self.known_ids[place], sizes

    def encode_spans(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of ascending spans one after the other, and the number of each span's ids; cut at the points inside spans."""
        low = np.searchsorted(points, starts, "right")
        inner = np.maximum(np.searchsorted(points, ends, "left") - low, 0)
        cut = points[np.repeat(low - np.cumsum(inner) + inner, inner) + np.arange(inner.sum())]
        full = ends > starts
        begin, end = np.sort(np.r_[starts[full], cut]), np.sort(np.r_[cut, ends[full]])
        found = [(np.zeros(0, self.kind), np.zeros(0, np.int64))]
        for at in range(0, len(begin), TOGETHER):
            some = slice(at, at + TOGETHER)
            found.append(self.encode_known([raw[a:z] for a, z in zip(begin[some].tolist(), end[some].tolist())]))
        ids, sizes = (np.concatenate(x) for x in zip(*found))
        last = np.r_[0, np.cumsum(sizes)][np.cumsum(np.where(full, inner + 1, 0))]
        return ids, np.diff(last, prepend=0)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


@functools.cache
def _coder(path: str) -> Coder:
    return Coder(path)


def _pieces(starts: np.ndarray, ends: np.ndarray, points: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """The spans, the long ones cut at points of agreement; and the number of pieces of each."""
    out, counts = [], []
    for a, z in zip(starts.tolist(), ends.tolist()):
        before = len(out)
        while z - a > PIECE:
            k = int(np.searchsorted(points, a + PIECE))
            if k == len(points) or points[k] >= z:
                break
            out.append((a, int(points[k])))
            a = int(points[k])
        out.append((a, z))
        counts.append(len(out) - before)
    return out, np.array(counts, np.int64)


def _split(path: str, bitmap: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, sent, seen = _coder(path), set(), TaskContext.get().partitionId() << 33
        for batch in (piece for batch in batches for piece in slices(batch, "text")):
            data, offsets, starts, ends, low, high, fp, check = _chunks(batch.column("text"))
            raw, hit = data.tobytes(), is_set(bitmap, fp)
            starts, ends, low, high, fp, check = (x[hit] for x in (starts, ends, low, high, fp, check))
            refs = np.bincount(np.searchsorted(offsets, starts, "right") - 1, minlength=len(batch)) if len(starts) else np.zeros(len(batch), np.int64)
            gap_starts, gap_ends = np.sort(np.r_[offsets[:-1], high]), np.sort(np.r_[offsets[1:], low])
            ids, gaps = coder.encode_spans(raw, gap_starts, gap_ends, agreements(data))
            bounds = np.r_[0, np.cumsum(refs + 1)]
            id_bounds = np.r_[0, np.cumsum(gaps)][bounds]
            pairs = pa.StructArray.from_arrays([pa.array(fp.view(np.int64)), pa.array(check.view(np.int64))], ["fp", "check"])
            n = len(batch)
            columns = [
                pa.array(seen + np.arange(n)), batch.column("doc_id"),
                pa.array([ids[a:z].tobytes() for a, z in zip(id_bounds[:-1], id_bounds[1:])], pa.binary()),
                pa.array([gaps[a:z].astype(np.uint32).tobytes() for a, z in zip(bounds[:-1], bounds[1:])], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(refs)].astype(np.int32)), pairs),
                pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()),
            ]
            seen += n
            names = ["row_id", "doc_id", "ids", "gaps", "refs", "fp", "check", "chunk"]
            yield pa.RecordBatch.from_arrays(columns, names)
            if len(sent) > 200_000:  # what is sent again is encoded once all the same
                sent.clear()
            new = [i for i, key in enumerate(zip(fp.tolist(), check.tolist())) if key not in sent and not sent.add(key)]
            if new:
                some, n = np.array(new), len(new)
                texts = [raw[a:z].decode() for a, z in zip(starts[some].tolist(), ends[some].tolist())]
                chunks = [fp[some].view(np.int64), check[some].view(np.int64)]
                none = [pa.nulls(n, k) for k in (pa.int64(), pa.int64(), pa.binary(), pa.binary(), columns[4].type)]
                yield pa.RecordBatch.from_arrays([*none, *(pa.array(c) for c in chunks), pa.array(texts, pa.string())], names)

    return run


def core_of(coder: Coder, chunk: str) -> np.ndarray:
    """Ids of a chunk between its first and last point of agreement; at all of them its encoding must break."""
    data = np.frombuffer(chunk.encode(), np.uint8)
    points = agreements(data)
    ids, _ = coder.encode([chunk])
    edges = np.r_[0, np.cumsum(coder.sizes[ids])]
    at = np.searchsorted(edges, points)
    if (edges[at] != points).any():
        raise ValueError(f"a token crosses the end of a word: this tokenizer can't reuse chunks: {chunk[:80]!r}")
    return ids[at[0] : at[-1]]


def _encode_chunks(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for batch in batches:
            cores = [core_of(coder, t).tobytes() for t in batch.column("chunk").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("fp"), batch.column("check"), pa.array(cores, pa.binary())], ["fp", "check", "core"])

    return run


def _assemble(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _coder(path).kind
        for batch in (b.slice(at, 256) for b in batches for at in range(0, len(b), 256)):
            rows, docs = [], batch.column("doc_id")
            for ids, gaps, cores in zip(*(batch.column(c).to_pylist() for c in ("ids", "gaps", "cores"))):
                own, bounds = np.frombuffer(ids, kind), np.r_[0, np.cumsum(np.frombuffer(gaps, np.uint32))].astype(np.int64)
                if len(cores or ()) + 2 != len(bounds):
                    raise ValueError("a shared chunk is missing")
                parts = [own[: bounds[1]]]
                for core, a, z in zip(cores or (), bounds[1:-1], bounds[2:]):
                    parts += [np.frombuffer(core["core"], kind), own[a:z]]
                rows.append(np.concatenate(parts).astype(np.int32))
            ends = np.cumsum([0, *map(len, rows)])
            flat = np.concatenate([np.zeros(0, np.int32), *rows])
            yield pa.RecordBatch.from_arrays([docs, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) for every row of docs, as the tokenizer encodes its text alone.

    A null or empty text has no ids; rows repeated, or without a doc_id, have their own rows. Texts of any length are
    encoded whole, in pieces cut at points of agreement. The tokenizer's file must be readable by the tasks.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = docs.mapInArrow(_count, f"{CHUNK}, n bigint").groupBy("fp", "check").agg(F.sum("n").alias("n"))
    shared = settle(counted.where("n > 1"), "shared-chunks")
    split = settle_packed(docs.mapInArrow(_split(tokenizer, bitmap_of(shared, "fp", FILTER_BITS)), ROW), "split-documents")
    texts = split.where("chunk is not null").groupBy("fp", "check").agg(F.any_value("chunk").alias("chunk"))
    cores = settle(texts.mapInArrow(_encode_chunks(tokenizer), f"{CHUNK}, core binary"), "chunk-ids")

    # A chunk that very many documents hold is dealt over several keys; at most 50,000 chunks can be such ones.
    rows = split.where("chunk is null").drop("fp", "check", "chunk")
    hot = max(HOT, (shared.agg(F.sum("n")).first()[0] or 0) // 50_000)
    often = settle(shared.where(F.col("n") >= hot).select("fp", "check", F.ceil(F.col("n") / hot).cast("bigint").alias("salts")), "hot-chunks")
    salts = F.coalesce("salts", F.lit(1))
    held = cores.join(F.broadcast(often), ["fp", "check"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
    refs = rows.where(F.size("refs") > 0).select("row_id", F.posexplode("refs").alias("nth", "ref")).select("row_id", "nth", "ref.*")
    refs = refs.join(F.broadcast(often), ["fp", "check"], "left").withColumn("salt", F.pmod("row_id", salts)).drop("salts")
    found = refs.join(held.drop("salts"), ["fp", "check", "salt"]).groupBy("row_id").agg(
        F.array_sort(F.collect_list(F.struct("nth", "core"))).alias("cores")
    )
    plain = rows.where(F.size("refs") == 0).withColumn("cores", F.lit(None).cast("array<struct<nth:int,core:binary>>"))
    mended = rows.where(F.size("refs") > 0).join(found, "row_id", "left")
    columns = ["doc_id", "ids", "gaps", "cores"]
    return plain.select(columns).unionByName(mended.select(columns)).mapInArrow(_assemble(tokenizer), "doc_id bigint, ids array<int>")


def digest_batches(path: str):
    """doc_id, n_tokens, and digests of the ids and of the text that they decode to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for batch in batches:
            counts, of_ids, of_texts = [], [], []
            bounds, flat = batch.column("ids").offsets.to_numpy(), batch.column("ids").values.to_numpy()
            for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                ids = flat[a:z].tolist()
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(coder.decimal.__getitem__, ids)).encode()).hexdigest())
                of_texts.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids), special tokens included; bytes that are no UTF-8 become U+FFFD."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(tokenizer)
        for batch in batches:
            texts = [coder.decode(row.as_py() or []) for row in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
