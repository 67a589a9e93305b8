"""Phrase collocations: exact counts of all frequent phrases of 2 to 4 words by tries, and their cohesion.

Words are taken per language. A phrase can be frequent only if all its parts are (Apriori). So, level by level:

1. Words are counted exactly. Frequent ones go into a bitmap of fixed size.
2. For lengths 2, 3 and 4: every task counts the phrases whose parts passed, by hash, in counters that stop at the
   threshold; the tasks' counters are summed. There are several counters for each word of the corpus, of which only
   those in use are held and sent. A phrase with a sum below the threshold is not frequent; all others pass (counters
   shared with other phrases can only let too many pass). Which counters pass leaves as a filter of some bits for each.
3. The phrases that passed are gathered once each: the candidates, a superset of the frequent phrases. A sample of the
   texts comes first; all tasks are told the keys that it holds, up to a bound, and send only other ones.
4. They are built into double-array tries of bounded size, broadcast one after the other. A task advances the
   states of all its text positions at once, word by word, and counts the accepting states in one array; the
   arrays are summed over the tasks. These counts are exact, overlaps included.

A trie holds at most TRIE candidates; more of them mean more passes over the text, not more memory. The number of
candidates falls with `least`: raise it with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from eventloom.llm.bitmaps import bitmap_of, is_set
from eventloom.llm.frames import settle
from eventloom.llm.words import buffer_of, lower_ascii, mix, slices, span_hashes, word_spans
from eventloom.operators.chunks import broadcast_if_small

LONGEST = 4
LEAST = 30
COVERED = 80  # percent of a phrase's occurrences in a longer one that make it a part of that one
TOP = 2000
SCALE = 2_000_000
WORD_BITS = 24
SKETCH_BITS = (16, 40)  # counters of a sketch: 2^SKETCH_SPARE a word of the corpus, within these bounds
SKETCH_SPARE = 3
COUNTERS = 2_000_000  # counters in use that a task holds at a time
FILTER_BITS = 28  # of the filter of a sketch, at most
PROBES = 4  # bits of a counter in it
BLOCK = 1 << 14
TRIE = 800_000
ROOMY = 3  # slots of a trie per node
SAMPLE = 16  # one text of so many is searched for candidates first
TOLD = 4_000_000  # keys of candidates told to every task, at most
BUCKET_WORDS = 1_000_000  # words of the corpus for each bucket of candidates
SLICE = 2 << 20
_SOLID = np.ones(256, bool)
_SOLID[list(b" \t.,;:!?\n\x0b\x0c\r")] = False
_ENDS = np.zeros(256, bool)
_ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _language_hashes(languages: list[str]) -> np.ndarray:
    data, offsets = buffer_of(pa.array(languages, pa.string()))
    return span_hashes(data, offsets[:-1], offsets[1:], 7)


@dataclass
class Words:
    """The words of some texts in order: where they are, their keys (language included), and whether one goes on from the one before."""

    raw: bytes
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray
    keys: np.ndarray
    joined: np.ndarray


def words_of(batch: pa.RecordBatch) -> Words:
    data, offsets = buffer_of(batch.column("text"))
    data = lower_ascii(data)
    starts, ends, firsts = word_spans(data, offsets, _SOLID)
    language = batch.column("lang").dictionary_encode()
    own = np.repeat(_language_hashes(language.dictionary.to_pylist())[language.indices.to_numpy()], np.diff(firsts)) if len(batch) else np.zeros(0, np.uint64)
    keys = mix(span_hashes(data, starts, ends) ^ own)
    stops = np.r_[0, np.cumsum(_ENDS[data])]
    joined = np.zeros(len(starts), bool)
    joined[1:] = stops[starts[1:]] == stops[ends[:-1]]
    joined[firsts[:-1][firsts[:-1] < len(starts)]] = False
    return Words(data.tobytes(), starts, ends, firsts, keys, joined)


def phrase_keys(words: np.ndarray, length: int) -> np.ndarray:
    """The key of the phrase of `length` words at every position that has so many after it."""
    n = max(len(words) - length + 1, 0)
    out = words[:n].copy()
    for k in range(1, length):
        out = mix(out * _STEP + words[k : k + n])
    return out


@dataclass
class Sketch:
    """Which of the 2^bits counters reached the threshold: for each bucket of counters a filter of 64-bit words."""

    bits: int
    filters: np.ndarray

    def holds(self, keys: np.ndarray) -> np.ndarray:
        counter, buckets = keys >> np.uint64(64 - self.bits), np.uint64(len(self.filters))
        at, bucket, rest = np.arange(len(keys)), (counter % buckets).astype(np.int64), counter // buckets
        for place in range(PROBES):
            bit = _probe(rest, place, 64 * self.filters.shape[1])
            hit = self.filters[bucket, (bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1) == 1
            at, bucket, rest = at[hit], bucket[hit], rest[hit]
        out = np.zeros(len(keys), bool)
        out[at] = True
        return out


def _probe(rest: np.ndarray, place: int, size: int) -> np.ndarray:
    """One of the bits, of `size`, a power of 2, that stand for a counter of a bucket."""
    return mix(rest + np.uint64(place * int(_STEP) % 2**64)) >> np.uint64(65 - size.bit_length())


def passing(words: Words, known: np.ndarray, sketches: list[Sketch]) -> list[np.ndarray]:
    """Per length from 1: the positions whose phrase, with all its parts, passes what is known so far; one length more, untested."""
    alive = np.flatnonzero(is_set(known, words.keys))
    levels = [alive]
    for length in range(2, len(sketches) + 3):
        here = np.zeros(len(words.keys) + 1, bool)
        here[levels[-1]] = True
        at = levels[-1]
        at = at[here[at + 1]]  # the phrase one word on passes as well
        at = at[words.joined[at + 1]]
        if length - 2 < len(sketches):
            keys = _keys_at(words, at, length)
            at = at[sketches[length - 2].holds(keys)]
        levels.append(at)
    return levels


def _keys_at(words: Words, at: np.ndarray, length: int) -> np.ndarray:
    out = words.keys[at]
    for k in range(1, length):
        out = mix(out * _STEP + words.keys[at + k])
    return out


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for batch in (piece for batch in batches for piece in slices(batch, "text", SLICE)):
        yield batch, words_of(batch)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, n) with the number of words, and rows (key, n)."""
    for batch, words in _pieces(batches):
        keys, times = np.unique(words.keys, return_counts=True)
        none = pa.nulls(len(keys), pa.string())
        yield pa.RecordBatch.from_arrays([none, pa.array(keys.view(np.int64)), pa.array(times)], ["lang", "key", "n"])
        yield pa.RecordBatch.from_arrays(
            [batch.column("lang").cast(pa.string()), pa.nulls(len(batch), pa.int64()), pa.array(np.diff(words.firsts))], ["lang", "key", "n"]
        )


# Sums of the tasks' counters


def _blocks(counters: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A task's counters, in compressed blocks without the empty ones."""
    import zstandard

    shard, press = TaskContext.get().partitionId() >> 7, zstandard.ZstdCompressor(level=1)
    for block in range(-(-len(counters) // BLOCK)):
        some = counters[block * BLOCK : (block + 1) * BLOCK]
        if some.any():
            columns = [pa.array([block], pa.int64()), pa.array([shard], pa.int64()), pa.array([press.compress(some.tobytes())], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["block", "shard", "counts"])


def _added(table: pa.Table) -> pa.Table:
    import zstandard

    read, total = zstandard.ZstdDecompressor(), None
    for counts in table.column("counts"):
        more = np.frombuffer(read.decompress(counts.as_py()), np.int64)
        total = more if total is None else total + more
    row = [table.column(c).slice(0, 1) for c in ("block", "shard")]
    return pa.table([*row, pa.array([zstandard.ZstdCompressor(level=1).compress(total.tobytes())], pa.binary())], names=["block", "shard", "counts"])


def _sum(blocks: DataFrame, label: str) -> DataFrame:
    """The tasks' blocks added up: 128 tasks at a time, then all, so that no group holds more than a 128th of them."""
    shape = "block bigint, shard bigint, counts binary"
    some = blocks.groupBy("block", "shard").applyInArrow(_added, shape)
    return settle(some.groupBy("block").applyInArrow(_added, shape), label)


def _steps(ordered: np.ndarray) -> bytes:
    """Ascending 64-bit numbers, packed: byte planes of their differences."""
    import zstandard

    steps = np.diff(ordered, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def _unstepped(packed: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(8, -1).T).reshape(-1).view(np.uint64), dtype=np.uint64)


def _summed(counters: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every counter once, in order, and its sum."""
    if not len(counters):
        return counters, times
    order = np.argsort(counters, kind="stable")
    counters, times = counters[order], times[order]
    first = np.flatnonzero(np.r_[True, counters[1:] != counters[:-1]])
    return counters[first], np.add.reduceat(times, first)


def _sketch(least: int, bits: int, buckets: int, known: np.ndarray, sketches: list[Sketch]):
    """A task's counters in use, each up to `least`, packed by bucket."""
    length = len(sketches) + 2

    def packed(counters: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        import zstandard

        press = zstandard.ZstdCompressor(level=1)
        bucket, rest = (counters % np.uint64(buckets)).astype(np.int64), counters // np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        bucket, rest, times = bucket[order], rest[order], np.minimum(times, least)[order].astype(np.uint32)
        edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else np.zeros(1, np.int64)
        spans = list(zip(edges[:-1].tolist(), edges[1:].tolist()))
        names = [_steps(rest[a:z]) for a, z in spans]
        counts = [press.compress(np.ascontiguousarray(times[a:z].view(np.uint8).reshape(-1, 4).T).tobytes()) for a, z in spans]
        columns = [pa.array(bucket[edges[:-1]]), pa.array(names, pa.binary()), pa.array(counts, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["bucket", "names", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        for _, words in _pieces(batches):
            keys = _keys_at(words, passing(words, known, sketches)[-1], length)
            held.append(np.unique(keys >> np.uint64(64 - bits), return_counts=True))
            if sum(len(c) for c, _ in held) >= COUNTERS:
                held = [_summed(*(np.concatenate(c) for c in zip(*held)))]
                if len(held[0][0]) >= COUNTERS // 2:
                    yield packed(*held.pop())
                    held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        yield packed(*_summed(*(np.concatenate(c) for c in zip(*held))))

    return run


def _reached(least: int):
    """The counters of a bucket whose sum is `least` or more."""

    def run(table: pa.Table) -> pa.Table:
        import zstandard

        read, names, times = zstandard.ZstdDecompressor(), [], []
        for name, counts in zip(table.column("names"), table.column("counts")):
            names.append(_unstepped(name.as_py()))
            planes = np.frombuffer(read.decompress(counts.as_py()), np.uint8)
            times.append(np.ascontiguousarray(planes.reshape(4, -1).T).reshape(-1).view(np.uint32).astype(np.int64))
        counters, sums = _summed(np.concatenate(names), np.concatenate(times))
        counters = counters[sums >= least]
        return pa.table([table.column("bucket").slice(0, 1), pa.array([len(counters)]), pa.array([_steps(counters)], pa.binary())], names=["bucket", "n", "names"])

    return run


def _filter(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filters = []
            for names in batch.column("names").to_pylist():
                some, bits = _unstepped(names), np.zeros(size, bool)
                for place in range(PROBES):
                    bits[_probe(some, place, size).astype(np.int64)] = True
                filters.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("bucket"), pa.array(filters, pa.binary())], ["bucket", "bits"])

    return run


def _sketched(docs: DataFrame, least: int, bits: int, buckets: int, known: np.ndarray, sketches: list[Sketch]) -> Sketch:
    """Which counters pass: 16 to 32 bits of filter for each, as long as FILTER_BITS suffice."""
    counted = docs.mapInArrow(_sketch(least, bits, buckets, known, sketches), "bucket bigint, names binary, counts binary")
    passed = settle(counted.groupBy("bucket").applyInArrow(_reached(least), "bucket bigint, n bigint, names binary"), "phrase-sketch")
    most = passed.agg(F.max("n")).first()[0] or 0
    size = 1 << max(min((16 * most).bit_length(), FILTER_BITS - buckets.bit_length()), 6)
    rows = passed.where("n > 0").mapInArrow(_filter(size), "bucket bigint, bits binary").toArrow()
    filters = np.zeros((buckets, size // 64), np.uint64)
    for bucket, packed in zip(rows.column("bucket").to_pylist(), rows.column("bits").to_pylist()):
        filters[bucket] = np.frombuffer(packed, np.uint64)
    return Sketch(bits, filters)


# Candidates


def _gather(known: np.ndarray, sketches: list[Sketch], buckets: int, told: np.ndarray):
    """Every candidate once a task, but for those told, in order, beforehand; packed in lists by the bucket of its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = np.zeros(0, np.uint64)
        for batch, words in _pieces(batches):
            levels = passing(words, known, sketches)
            singles = np.union1d(levels[1], levels[1] + 1)
            at = np.concatenate([singles, *levels[1:LONGEST]])
            length = np.repeat(np.arange(1, LONGEST + 1), [len(singles), *map(len, levels[1:LONGEST])])
            keys = np.concatenate([words.keys[singles], *(_keys_at(words, levels[k - 1], k) for k in range(2, LONGEST + 1))])
            keys, where = np.unique(keys, return_index=True)
            for before in (told, sent):
                if len(before):
                    new = before[np.minimum(np.searchsorted(before, keys), len(before) - 1)] != keys
                    keys, where = keys[new], where[new]
            sent = np.union1d(sent, keys) if len(sent) < 4_000_000 else keys
            bucket = (keys % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            keys, bucket, at, length = keys[order], bucket[order], at[where[order]], length[where[order]]
            phrases = [b" ".join([words.raw[a:z] for a, z in zip(*span)]).decode() for span in _spans(words, at, length)]
            doc = np.searchsorted(words.firsts, at, "right") - 1
            edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(at) else np.zeros(1, np.int64)
            lists = (
                pa.array(keys.view(np.int64)), pa.array(length.astype(np.int32)),
                batch.column("lang").cast(pa.string()).take(pa.array(doc)), pa.array(phrases, pa.string()),
            )
            packed = [pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), values) for values in lists]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]]), *packed], ["bucket", "key", "k", "lang", "phrase"])

    return run


def _spans(words: Words, at: np.ndarray, length: np.ndarray) -> Iterator[tuple[list[int], list[int]]]:
    """Starts and ends of the words of each phrase."""
    starts, ends = words.starts.tolist(), words.ends.tolist()
    return ((starts[i : i + k], ends[i : i + k]) for i, k in zip(at.tolist(), length.tolist()))


def _once(table: pa.Table) -> pa.Table:
    """The different candidates of a bucket, and how many lists of it have each."""
    flat = pa.table({c: pa.chunked_array([x.flatten() for x in table.column(c).chunks]) for c in ("key", "k", "lang", "phrase")})
    _, where, lists = np.unique(flat.column("key").to_numpy(), return_index=True, return_counts=True)
    return flat.take(pa.array(where)).append_column("lists", pa.array(lists))


def _gathered(docs: DataFrame, known: np.ndarray, sketches: list[Sketch], buckets: int) -> DataFrame:
    """The candidates: key, k, lang, phrase. Those of the sample that most tasks have are told to all, which then send only others."""
    shape = "bucket bigint, key array<bigint>, k array<int>, lang array<string>, phrase array<string>"
    search = lambda rows, told, label: settle(
        rows.mapInArrow(_gather(known, sketches, buckets, told), shape).groupBy("bucket").applyInArrow(_once, "key bigint, k int, lang string, phrase string, lists bigint"),
        label,
    )
    first = search(docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0), np.zeros(0, np.uint64), "sampled-candidates")
    held = first.where("lists > 1") if first.count() > TOLD else first
    held = held.orderBy(F.desc("lists"), "key").limit(TOLD) if held.count() > TOLD else held
    held = settle(held.select("key", "k", "lang", "phrase"), "told-candidates")
    told = np.sort(held.select("key").toArrow().column("key").to_numpy().view(np.uint64))
    return settle(held.unionByName(search(docs, told, "other-candidates").drop("lists")), "phrase-candidates")


# Tries


@dataclass
class Trie:
    """base, check, number: from a state s (a slot) the word w leads to base[s] + w if check is s there; number counts candidates.

    symbols holds the keys of the words, in order: a word is its place there. The root is state 0.
    """

    symbols: np.ndarray
    base: np.ndarray
    check: np.ndarray
    number: np.ndarray

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states after one more word each; -1 where there is none."""
        to = self.base[states] + symbols
        inside = (to > 0) & (to < len(self.check))
        to = np.where(inside, to, 0)
        return np.where(inside & (self.check[to] == states) & (symbols >= 0), to, -1)


def build_trie(paths: np.ndarray, lengths: np.ndarray, seed: int = 1) -> Trie:
    """The trie of phrases given as rows of word keys; phrase i has number i.

    Nodes with most children are placed first, at the first of some random bases whose slots are free, or, failing
    that, behind all others; nodes with one child take any free slot.
    """
    symbols = np.unique(np.concatenate([np.unique(paths[:, k][lengths > k]) for k in range(paths.shape[1])] or [np.zeros(0, np.uint64)]))
    node, nodes = np.zeros(len(paths), np.int64), 1
    parent, symbol, number_of = [np.array([-1])], [np.array([-1])], {}
    for k in range(paths.shape[1]):
        long = np.flatnonzero(lengths > k)
        edges, which = np.unique(node[long] * (len(symbols) + 1) + np.searchsorted(symbols, paths[long, k]), return_inverse=True)
        parent.append(edges // (len(symbols) + 1))
        symbol.append(edges % (len(symbols) + 1))
        node[long] = nodes + which
        nodes += len(edges)
    parent, symbol = np.concatenate(parent), np.concatenate(symbol)
    order = np.argsort(parent[1:], kind="stable") + 1  # nodes by parent, symbols ascending
    parents, begin, count = np.unique(parent[order], return_index=True, return_counts=True)
    random, width = np.random.default_rng(seed), len(symbols)
    size = ROOMY * nodes + 2 * width + 2
    used = np.zeros(size, bool)
    used[0] = True
    base_of = np.zeros(nodes, np.int64)
    end = 1
    for i in np.argsort(-count, kind="stable").tolist():
        if count[i] == 1:
            break
        children = symbol[order[begin[i] : begin[i] + count[i]]]
        for _ in range(8):
            bases = random.integers(1, max(size - width, 2), 32)
            free = ~used[bases[:, None] + children].any(axis=1)
            if free.any():
                base = int(bases[np.argmax(free)])
                break
        else:
            end = max(end, int(np.flatnonzero(used)[-1]) + 1)
            if end + width >= len(used):
                used = np.concatenate([used, np.zeros(max(len(used) // 2, 2 * width), bool)])
            base = end - int(children[0]) if end > children[0] else end
            while used[base + children].any():
                base += 1
        used[base + children] = True
        base_of[parents[i]] = base
    single = np.flatnonzero(count == 1)
    free = np.flatnonzero(~used)
    if len(free) < len(single):
        free = np.r_[free, len(used) + np.arange(len(single) - len(free))]
    base_of[parents[single]] = free[: len(single)] - symbol[order[begin[single]]]
    slots = np.zeros(nodes, np.int64)
    slots[1:] = base_of[parent[1:]] + symbol[1:]
    last = int(slots.max()) + 1
    base, check, number = np.zeros(last, np.int32), np.full(last, -1, np.int32), np.full(last, -1, np.int32)
    base[slots] = base_of
    check[slots[1:]] = slots[parent[1:]]
    number[slots[node]] = np.arange(len(paths))
    return Trie(symbols, base, check, number)


def _trie_of(candidates: pa.Table) -> tuple[Trie, np.ndarray]:
    """The trie of candidates (key, k, lang, phrase), and their keys by number."""
    candidates = candidates.sort_by("key")
    keys = candidates.column("key").to_numpy().view(np.uint64)
    data, offsets = buffer_of(candidates.column("phrase").combine_chunks())
    starts, ends, firsts = word_spans(data, offsets, _SOLID)
    lengths = np.diff(firsts)
    language = candidates.column("lang").combine_chunks().dictionary_encode()
    own = _language_hashes(language.dictionary.to_pylist())[language.indices.to_numpy()]
    words = mix(span_hashes(data, starts, ends) ^ np.repeat(own, lengths))
    paths = np.zeros((len(keys), LONGEST), np.uint64)
    for k in range(LONGEST):
        some = lengths > k
        paths[some, k] = words[firsts[:-1][some] + k]
    return build_trie(paths, lengths), keys


def _count_phrases(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, candidates = broadcast.value
        counts = np.zeros(candidates, np.int64)
        for _, words in _pieces(batches):
            place = np.minimum(np.searchsorted(trie.symbols, words.keys), len(trie.symbols) - 1)
            symbols = np.where(trie.symbols[place] == words.keys, place, -1)
            at = np.flatnonzero(symbols >= 0)
            states, accepted = np.zeros(len(at), np.int64), []
            for depth in range(LONGEST):
                states = trie.step(states, symbols[at + depth])
                alive = states >= 0
                at, states = at[alive], states[alive]
                found = trie.number[states]
                accepted.append(found[found >= 0])
                inside = at + depth + 1 < len(symbols)
                at, states = at[inside], states[inside]
                on = words.joined[at + depth + 1]
                at, states = at[on], states[on]
            counts += np.bincount(np.concatenate(accepted), minlength=candidates)
        yield from _blocks(counts)

    return run


def _keyed(keys: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        for batch in batches:
            for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist()):
                n = np.frombuffer(zstandard.ZstdDecompressor().decompress(counts), np.int64)
                own = keys[block * BLOCK :][: len(n)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n)], ["key", "f"])

    return run


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, k, f) of all words and phrases of 2 to 4 words found `least` times or more; and (lang, n), all words.

    Only words that are part of a phrase that may be frequent are listed. Words are runs of bytes other than blanks
    and tabs in texts cut at `.,;:!?` and line ends, A-Z in lower case; phrases don't cross cuts. A null text has no
    words; a null lang is `und`. Rows repeated count as often as they come. Words and phrases are told apart by
    64-bit hashes: two of the corpus share one with a probability of about (number of different ones)^2 / 2^65.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    words = docs.mapInArrow(_count_words, "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n"))
    words = settle(words.where(F.col("key").isNull() | (F.col("n") >= least)), "phrase-words")
    totals = words.where("key is null").select("lang", "n")
    known = bitmap_of(words.where("key is not null"), "key", WORD_BITS)
    total = totals.agg(F.sum("n")).first()[0] or 0
    bits = min(max(total.bit_length() + SKETCH_SPARE, SKETCH_BITS[0]), SKETCH_BITS[1])
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_WORDS)
    sketches: list[Sketch] = []
    for _ in range(2, LONGEST + 1):
        sketches.append(_sketched(docs, least, bits, buckets, known, sketches))
    candidates = _gathered(docs, known, sketches, buckets)
    longer = candidates.where("k > 1")
    tries = max(1, -(-longer.count() // TRIE))
    counts = words.where("key is not null").select("key", F.col("n").alias("f"))
    for turn in range(tries):
        trie, keys = _trie_of(longer.where(F.pmod(F.xxhash64("key"), F.lit(tries)) == turn).toArrow())
        sent = spark.sparkContext.broadcast((trie, len(keys)))
        if len(keys):
            blocks = docs.mapInArrow(_count_phrases(sent), "block bigint, shard bigint, counts binary")
            counts = counts.unionByName(_sum(blocks, "phrase-counts").mapInArrow(_keyed(keys), "key bigint, f bigint"))
        sent.unpersist()
    found = candidates.join(counts.where(F.col("f") >= least), "key").select("lang", "phrase", "k", "f")
    return settle(found, "frequent-phrases"), totals


def _part(words: str, start: int | str, length: int | str) -> F.Column:
    return F.expr(f"array_join(slice({words}, {start}, {length}), ' ')")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED) -> DataFrame:
    """Per lang the `top` phrases by cohesion: lang, rank, phrase, a, l, r, n, score.

    a is the phrase's count; l and r are those of its two parts at the cut with the lowest floor(2000000 a / (l + r)),
    the score; of equal ones the cut after fewer words counts. A phrase that lies in a longer frequent one which has
    `covered` percent of its count or more is left out. Ranks go by score and a, descending, and phrase, bytewise.
    Without frequent phrases there are no rows.
    """
    found, totals = frequent_phrases(docs, least)
    phrases = found.where("k > 1").withColumn("words", F.split("phrase", " "))
    lengths = F.sequence(F.lit(2), F.col("k") - 1)
    inner = (
        phrases.where("k > 2")
        .select("lang", "k", "words", "f", F.explode(lengths).alias("m"))
        .select("lang", "words", "f", "m", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("m") + 1)).alias("i"))
        .select("lang", _part("words", "i", "m").alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    rest = phrases.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("f").cast("decimal(20,0)") * covered)
    )
    part = found.select("lang", F.col("phrase").alias("part"), F.col("f").alias("of_part"))
    cuts = rest.select("lang", "phrase", "words", "k", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"left": _part("words", "1", "cut"), "right": _part("words", "cut + 1", "k - cut")}).drop("words")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(part.withColumnsRenamed({"part": side, "of_part": name}), ["lang", side])
    score = F.expr(f"cast((cast(a as decimal(20,0)) * {SCALE}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0))) as bigint)")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("best"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "best.l", "best.r", "best.score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(broadcast_if_small(totals), "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
