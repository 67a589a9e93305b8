"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so a document's Jaccard similarity with an item it holds is
tiny. Items are therefore partitioned by size, and for each partition of sizes up to m every document is
seen through windows of 2 m shingles, m apart: a passage of up to m shingles lies whole in one of them,
where its similarity with the item is at least about 0.19 for a containment of 0.8. With 64 one-row bands
a candidate is then missed with a probability of about 1e-6. Items of up to SMALLEST shingles are not left
to chance: every document that holds one of their shingles is a candidate. Candidates are verified by the
exact share of the item's shingles that the whole document holds. A longer item whose shingles lie scattered
over much more than its own length is not searched for.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.words import buffer_of, slices, texts_shingles, word_hashes, mix

WIDTH, PERCENT = 5, 80
BANDS = 64
SMALLEST = 8  # shingles of the smallest size partition, whose items are looked up by shingle
ITEMS_AT_ONCE = 20_000  # items told to every task in one pass over the documents
_STEP = np.uint64(0xD6E8FEB86659FD93)
RESULT = "doc_id bigint, item_id bigint, item_shingles bigint, common bigint, containment double"


def _band_factors() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(42).integers(1, 2**63, (2, BANDS), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def _level(size: int) -> int:
    """Size partition of an item: sizes up to SMALLEST * 2^level."""
    return max(0, (-(-size // SMALLEST) - 1).bit_length())


class ItemIndex:
    """Shingles of the smallest items, band values of the others by size partition, all shingles for verification."""

    def __init__(self, ids: list[int], texts: list[str], width: int) -> None:
        sets = texts_shingles(pa.array(texts, pa.large_string()), width, False)
        factors, shifts = _band_factors()
        self.width = width
        self.items = [(i, s) for i, s in zip(ids, sets) if len(s)]
        small = [k for k, (_, s) in enumerate(self.items) if not _level(len(s))]
        shingles = np.concatenate([np.zeros(0, np.uint64), *(self.items[k][1] for k in small)])
        order = np.argsort(shingles, kind="stable")
        self.small = shingles[order], np.repeat(np.array(small, np.int64), [len(self.items[k][1]) for k in small])[order]
        self.levels: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for level in sorted({_level(len(s)) for _, s in self.items} - {0}):
            members = np.array([k for k, (_, s) in enumerate(self.items) if _level(len(s)) == level])
            bands = []
            for a, b in zip(factors, shifts):
                least = np.array([(self.items[k][1] * a + b).min() for k in members])
                order = np.argsort(least, kind="stable")
                bands.append((least[order], members[order]))
            self.levels[level] = bands

    def _sharing(self, shingles: np.ndarray, firsts: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs of the smallest items that share a shingle."""
        known, members = self.small
        if not len(known) or not len(shingles):
            return set()
        low = np.searchsorted(known, shingles, "left")
        at = np.flatnonzero(known[np.minimum(low, len(known) - 1)] == shingles)
        doc = np.searchsorted(firsts, at, "right") - 1
        found: set[tuple[int, int]] = set()
        for d, a in np.unique(np.stack([doc, low[at]], axis=1), axis=0).tolist():
            z = int(np.searchsorted(known, known[a], "right"))
            found.update((d, k) for k in members[a:z].tolist())
        return found

    def candidates(self, shingles: np.ndarray, firsts: np.ndarray) -> set[tuple[int, int]]:
        """(document, item) pairs that share a band value in a window, or a shingle if the item is one of the smallest.

        firsts: each document's first shingle.
        """
        return self._sharing(shingles, firsts) | self._banded(shingles, firsts)

    def _banded(self, shingles: np.ndarray, firsts: np.ndarray) -> set[tuple[int, int]]:
        sizes = np.diff(firsts)
        blocks = -(-sizes // SMALLEST)  # of SMALLEST shingles, none across documents
        ends = np.cumsum(blocks)
        if not len(ends) or not ends[-1] or not self.levels:
            return set()
        doc = np.repeat(np.arange(len(sizes)), blocks)
        nth = np.arange(len(doc)) - (ends - blocks)[doc]
        starts = firsts[doc] + nth * SMALLEST
        windows = {}
        for level in self.levels:
            step = 1 << level
            first = np.flatnonzero((nth % step == 0) & ((nth == 0) | (nth + step < blocks[doc])))
            last = np.minimum(first + 2 * step, ends[doc[first]])
            windows[level] = (first, np.stack([first, last], axis=1).ravel())
        found: set[tuple[int, int]] = set()
        for band, (a, b) in enumerate(zip(*_band_factors())):
            least = np.append(np.minimum.reduceat(shingles * a + b, starts), np.uint64(2**64 - 1))
            for level, bands in self.levels.items():
                first, edges = windows[level]
                values = np.minimum.reduceat(least, edges)[::2]
                known, members = bands[band]
                low = np.searchsorted(known, values, "left")
                for at in np.flatnonzero(known[np.minimum(low, len(known) - 1)] == values).tolist():
                    high = int(np.searchsorted(known, values[at], "right"))
                    found.update((int(doc[first[at]]), int(k)) for k in members[low[at] : high])
        return found


def _rolled(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of each text in order, repeated ones too, and each text's first one."""
    words, firsts = word_hashes(*buffer_of(column))
    count = max(len(words) - width + 1, 0)
    rolled = np.zeros(count, np.uint64)
    for k in range(width if count else 0):
        rolled = mix(rolled * _STEP + words[k : count + k])
    sizes = np.maximum(np.diff(firsts) - width + 1, 0)
    text = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.cumsum(sizes) - sizes
    inside = firsts[:-1][text] + np.arange(len(text)) - begin[text]
    return rolled[inside], np.r_[0, np.cumsum(sizes)]


def _search(index: ItemIndex, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for batch in batches for piece in slices(batch, "text")):
            shingles, firsts = _rolled(batch.column("text"), index.width)
            ids = batch.column("doc_id").to_pylist()
            rows, held, of = [], None, -1
            for doc, k in sorted(index.candidates(shingles, firsts)):
                if doc != of:
                    held, of = np.unique(shingles[firsts[doc] : firsts[doc + 1]]), doc
                item, wanted = index.items[k]
                common = int(np.isin(wanted, held, assume_unique=True).sum())
                if 100 * common >= percent * len(wanted):
                    rows.append((ids[doc], item, len(wanted), common, common / len(wanted)))
            if rows:
                kinds = [pa.int64()] * 4 + [pa.float64()]
                names = [c.split()[0] for c in RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document and item of which the document holds at least `percent` % of the shingles.

    Words are compared with A-Z in lower case. Items or documents with fewer than `width` words, null or
    empty ones, match nothing; an item with a null item_id is searched for like any other. Repeated documents are searched each on their own, repeated items once.
    Items go to the tasks in passes of about ITEMS_AT_ONCE, so a pass's index has a bounded size.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null").distinct()
    passes = max(1, -(-items.count() // ITEMS_AT_ONCE))
    results = []
    for turn in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == turn).orderBy("item_id", "text").collect()
        index = ItemIndex([r["item_id"] for r in part], [r["text"] for r in part], width)
        results.append(docs.mapInArrow(_search(index, percent), RESULT))
    found = reduce(DataFrame.unionByName, results)
    return found
