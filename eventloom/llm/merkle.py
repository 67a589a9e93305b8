"""A Merkle manifest of a table, with octopus multiproofs: one fetch of nodes for all proofs of a leaf partition.

Leaves are grouped (by source, say); each group has a tree of fan-out 16 and the group roots, in group order,
have one tree above them. H is the hex SHA-256 of inputs joined as hex text; a lone node is its own root.

1. Leaves are hashed in the JVM and sorted by (group, item, hash) over range partitions. Counts per partition
   give every leaf its place in its group. A leaf partition is a run of `PART` consecutive leaves, so it holds
   parts of one big group or many whole small ones, and no group, however big, meets in one task.
2. Each leaf partition derives all nodes that lie wholly under its own leaves and sends on only its frontier:
   nodes whose parent reaches into a neighbour, at most 30 a level. Levels above are joined from those.
3. Each leaf partition lists the minimal union of node coordinates that its proofs need and that it can't derive
   itself (again at most 30 a level), fetches them in one join, derives the interiors that its proofs share, and
   expands every single proof locally.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.frames import settle
from eventloom.operators.chunks import broadcast_if_small, carry_before

BITS = 4
FAN = 1 << BITS
PART = 50_000  # leaves of one task: about 20 MB of hashes, nodes and proof tails
TOP = -1  # the tree of the group roots; the others are numbered in group order
NODE = "tree bigint, level int, idx bigint, size bigint, hash binary"
PROOF = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def framed(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, `:`, value: no two lists of values give the same text."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(columns: list[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[framed(c) for c in columns]), 256))


def _size_at(level: Column | int) -> Column:
    """Number of nodes of a level, from the number of leaves in `size`."""
    shift = level * BITS
    return F.expr(f"shiftright(size - 1, {shift}) + 1") if isinstance(level, int) else F.call_function("shiftright", F.col("size") - 1, shift) + 1


def _place(leaves: DataFrame, part: int) -> DataFrame:
    """leaves (doc_id, source, leaf, claimed) with tree, idx, size and part."""
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    ordered = leaves.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    ordered = settle(ordered, "merkle-leaves").withColumns(
        {"_task": F.shiftright("_at", 33), "_row": F.col("_at").bitwiseAND((1 << 33) - 1)}
    )
    tasks = settle(ordered.groupBy("_task").agg(F.count("*").alias("_n")), "merkle-tasks")
    tasks = carry_before(tasks, [], "_task", "_n", "sum", "_before").select("_task", "_before")
    numbered = (
        ordered.join(broadcast_if_small(tasks), "_task")
        .withColumn("_g", F.col("_before") + F.col("_row"))
        .withColumns({"part": F.floor(F.col("_g") / part).cast("bigint"), "_key": framed(F.col("source"))})
        .drop("_at", "_task", "_row", "_before")
    )
    runs = settle(numbered.groupBy("part", "_key").agg(F.min("_g").alias("_first"), F.count("*").alias("_n")), "merkle-runs")
    groups = runs.groupBy("_key").agg(F.min("_first").alias("_start"), F.min("part").alias("_part"), F.sum("_n").alias("size"))
    groups = settle(groups, "merkle-groups")
    per_part = carry_before(groups.groupBy("_part").agg(F.count("*").alias("_n")), [], "_part", "_n", "sum", "_before").drop("_n")
    within = Window.partitionBy("_part").orderBy("_start")
    groups = (
        groups.withColumn("_nth", F.row_number().over(within))
        .join(per_part, "_part")
        .select("_key", "_start", "size", (F.col("_before") + F.col("_nth") - 1).alias("tree"))
    )
    runs = settle(runs.select("part", "_key").join(groups, "_key"), "merkle-places")
    return numbered.join(broadcast_if_small(runs), ["part", "_key"]).select(
        "part", "tree", (F.col("_g") - F.col("_start")).alias("idx"), "size", "doc_id", "leaf", "claimed"
    )


def _hash(joined: bytes) -> bytes:
    return hashlib.sha256(joined).hexdigest().encode()


def _runs(table: pa.Table) -> Iterator[tuple[int, int, int, list[int]]]:
    """(tree, first idx, size, rows) of each tree's run in a leaf partition, rows in order."""
    trees, places, sizes = (table.column(c).to_pylist() for c in ("tree", "idx", "size"))
    order = sorted(range(len(trees)), key=lambda i: (trees[i], places[i]))
    at = 0
    while at < len(order):
        to = at
        while to < len(order) and trees[order[to]] == trees[order[at]]:
            to += 1
        yield trees[order[at]], places[order[at]], sizes[order[at]], order[at:to]
        at = to


def _hex(column: pa.ChunkedArray) -> list[bytes | None]:
    return [None if v is None else v.hex().encode() for v in column.to_pylist()]


def frontier(lo: int, digests: list[bytes], size: int) -> Iterator[tuple[int, int, bytes]]:
    """(level, idx, hash) of the nodes at and above a run of leaves whose parent isn't wholly above the run; or the root."""
    level = 0
    while size > 1:
        hi = lo + len(digests)
        first, last = -(-lo // FAN), -(-hi // FAN) if hi == size else hi // FAN
        if last <= first:
            break
        yield from ((level, i, digests[i - lo]) for i in (*range(lo, first * FAN), *range(min(last * FAN, hi), hi)))
        digests = [_hash(b"".join(digests[p * FAN - lo : (p + 1) * FAN - lo])) for p in range(first, last)]
        lo, size, level = first, -(-size // FAN), level + 1
    yield from ((level, lo + i, d) for i, d in enumerate(digests))


def missing(lo: int, hi: int, size: int) -> Iterator[tuple[int, int]]:
    """(level, idx): the least set of nodes that, with the leaves lo to hi, gives the proofs of all of these."""
    level = 0
    while size > 1:
        first, last = lo // FAN, (hi - 1) // FAN + 1
        yield from ((level, i) for i in (*range(first * FAN, lo), *range(hi, min(last * FAN, size))))
        lo, hi, size, level = first, last, -(-size // FAN), level + 1


def _frontier_of(table: pa.Table) -> pa.Table:
    leaves, rows = _hex(table.column("leaf")), []
    for tree, lo, size, at in _runs(table):
        rows += [(tree, level, i, size, bytes.fromhex(h.decode())) for level, i, h in frontier(lo, [leaves[k] for k in at], size)]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["tree", "level", "idx", "size", "hash"])


def _climb(known: DataFrame, depth: int) -> DataFrame:
    """All nodes that the known ones give, level by level: each parent's children are all known by its turn."""
    levels = [known.where("level = 0")]
    for level in range(depth):
        children = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", F.lower(F.hex("hash")).alias("h")))), lambda c: c["h"]), "")
        parents = (
            levels[-1].where(_size_at(level) > 1)
            .groupBy("tree", "size", F.shiftright("idx", BITS).alias("idx"))
            .agg(F.unhex(F.sha2(children, 256)).alias("hash"))
            .select("tree", F.lit(level + 1).alias("level"), "idx", "size", "hash")
        )
        levels.append(settle(known.where(F.col("level") == level + 1).unionByName(parents), "merkle-level"))
    nodes = levels[0]
    for more in levels[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def _roots(nodes: DataFrame) -> DataFrame:
    return nodes.where((_size_at(F.col("level")) == 1) & (F.col("idx") == 0))


def _depth(frame: DataFrame) -> int:
    """Levels above the leaves of the largest tree."""
    size, depth = frame.agg(F.max("size")).first()[0] or 1, 0
    while size > 1:
        size, depth = -(-size // FAN), depth + 1
    return depth


@dataclass
class Manifest:
    """leaves: part, tree, idx, size, doc_id, leaf, claimed; nodes: NODE, those at partition borders; root: hex or None."""

    leaves: DataFrame
    nodes: DataFrame
    root: str | None


def build(leaves: DataFrame, part: int = PART) -> Manifest:
    """The manifest of leaves (doc_id bigint, source string, leaf binary, claimed binary).

    Groups are ordered by source, null first, UTF-8 bytewise; within a group leaves ascend by doc_id, null first, and
    by hash where ids repeat, so equal rows are equal leaves side by side. Without leaves there is no root.
    """
    placed = _place(settle(leaves.select("doc_id", "source", "leaf", "claimed"), "merkle-hashes"), part)
    borders = placed.select("part", "tree", "idx", "size", "leaf").groupBy("part").applyInArrow(_frontier_of, NODE)
    borders = settle(borders, "merkle-frontier")
    nodes = _climb(borders, _depth(borders))
    roots = settle(_roots(nodes).select("tree", "hash"), "merkle-subroots")
    total = roots.count()
    tops = roots.select(
        F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"), F.lit(total).cast("bigint").alias("size"), "hash"
    )
    tops = _climb(tops, _depth(tops))
    nodes = settle(nodes.unionByName(tops), "merkle-nodes")
    root = _roots(nodes.where(F.col("tree") == TOP)).select(F.lower(F.hex("hash"))).first()
    return Manifest(placed, nodes, root[0] if root else None)


def _coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [
            (part, tree, level, i)
            for part, tree, lo, hi, size in zip(*(batch.column(c).to_pylist() for c in ("part", "tree", "lo", "hi", "size")))
            for level, i in missing(lo, hi, size)
        ]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        columns = zip(*rows) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], ["part", "tree", "level", "idx"])


def _derive(tree: int, lo: int, digests: list[bytes], size: int, fetched: dict) -> tuple[list[tuple[int, list[bytes]]], bytes]:
    """Per level: number of the first run of 16 and the runs, joined; and the root. A missing node is a KeyError."""
    levels: list[tuple[int, list[bytes]]] = []
    while size > 1:
        hi, level = lo + len(digests), len(levels)
        first, last = lo // FAN, (hi - 1) // FAN + 1
        row = [fetched[tree, level, i] for i in range(first * FAN, lo)] + digests
        row += [fetched[tree, level, i] for i in range(hi, min(last * FAN, size))]
        runs = [b"".join(row[k : k + FAN]) for k in range(0, len(row), FAN)]
        levels.append((first, runs))
        digests, lo, size = [_hash(r) for r in runs], first, -(-size // FAN)
    return levels, digests[0]


def _around(levels: list[tuple[int, list[bytes]]], level: int, idx: int) -> tuple[bytes, bytes]:
    """What lies before and after a node in its run."""
    first, runs = levels[level]
    run, cut = runs[(idx >> BITS) - first], 64 * (idx % FAN)
    return run[:cut], run[cut + 64 :]


def _siblings(levels: list[tuple[int, list[bytes]]], level: int, idx: int) -> bytes:
    """Siblings of a node and of all nodes above it, level by level, joined."""
    return b"".join(b"".join(_around(levels, k, idx >> BITS * (k - level))) for k in range(level, len(levels)))


def _fold(levels: list[tuple[int, list[bytes]]], idx: int, digest: bytes) -> bytes:
    for level in range(len(levels)):
        before, after = _around(levels, level, idx)
        digest, idx = _hash(before + digest + after), idx >> BITS
    return digest


def _expand(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
    fetched = dict(zip(zip(*(nodes.column(c).to_pylist() for c in ("tree", "level", "idx"))), _hex(nodes.column("hash"))))
    own, claimed, ids = _hex(leaves.column("leaf")), _hex(leaves.column("claimed")), leaves.column("doc_id").to_pylist()
    trees = [(tree, lo, at, *_derive(tree, lo, [own[k] for k in at], size, fetched)) for tree, lo, size, at in _runs(leaves)]
    total = leaves.column("groups")[0].as_py() if len(ids) else 0
    tops, root = _derive(TOP, trees[0][0], [t[4] for t in trees], total, fetched) if trees else ([], b"")
    rows = []
    for tree, lo, at, levels, subroot in trees:
        upper = _siblings(tops, 0, tree)
        tail, tail_of = upper, -1
        for i, k in enumerate(at, lo):
            if levels and i >> BITS != tail_of:  # the 16 leaves of a run share the rest of the proof
                tail_of = i >> BITS
                tail = _siblings(levels, 1, tail_of) + upper
            proof = b"".join(_around(levels, 0, i)) + tail if levels else upper
            folded = _fold(tops, tree, _fold(levels, i, claimed[k] or own[k]))
            rows.append((ids[k], own[k].decode(), subroot.decode(), root.decode(), _hash(proof).decode(), folded.decode(), folded == root))
    kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
    columns = zip(*rows) if rows else [[]] * 7
    return pa.table(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)],
        names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    )


def prove(manifest: Manifest) -> DataFrame:
    """PROOF for every leaf: its proof's digest, and the root folded from `claimed` (where null: the leaf) and the proof."""
    leaves = manifest.leaves
    runs = settle(
        leaves.groupBy("part", "tree", "size").agg(F.min("idx").alias("lo"), (F.max("idx") + 1).alias("hi")), "merkle-proof-runs"
    )
    groups = (runs.agg(F.max("tree")).first()[0] or 0) + 1
    tops = runs.groupBy("part").agg(F.min("tree").alias("lo"), (F.max("tree") + 1).alias("hi"))
    tops = tops.select("part", F.lit(TOP).cast("bigint").alias("tree"), F.lit(groups).cast("bigint").alias("size"), "lo", "hi")
    wanted = runs.unionByName(tops).mapInArrow(_coordinates, "part bigint, tree bigint, level int, idx bigint")
    fetched = settle(
        wanted.join(manifest.nodes, ["tree", "level", "idx"], "left").select("part", "tree", "level", "idx", "hash"), "merkle-fetched"
    )
    left = leaves.select("part", "tree", "idx", "size", "doc_id", "leaf", "claimed", F.lit(groups).cast("bigint").alias("groups"))
    return left.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(_expand, PROOF)


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def document_leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaves of a documents table; `claimed` is the hash with A-Z of the text lower-cased where `tampered` holds.

    Nulls in any column are hashed as `-`; columns other than COLUMNS are not part of a leaf. `claimed` is null
    where it would equal the leaf, so a text without A-Z, or a null one, verifies.
    """
    leaf = leaf_hash([F.col(c) for c in COLUMNS])
    other = leaf_hash([*[F.col(c) for c in COLUMNS[:-1]], F.translate("text", UPPER, LOWER)])
    claimed = F.lit(None).cast("binary") if tampered is None else F.when(tampered & (F.translate("text", UPPER, LOWER) != F.col("text")), other)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf.alias("leaf"), claimed.alias("claimed")
    )


def fifth(doc_id: Column) -> Column:
    """Whether 5 divides the unsigned CRC-32 of the decimal id; not for a null one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
