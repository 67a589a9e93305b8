"""The Merkle manifest against plain Python."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventloom.llm import merkle
from tests.helpers import SF_SMALL

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def H(joined):
    return hashlib.sha256(joined.encode()).hexdigest()


def framed(values):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_paths(hashes):
    """Each leaf's runs of (before, after) up to the root, and the root."""
    paths, at, where = [[] for _ in hashes], list(hashes), list(range(len(hashes)))
    while len(at) > 1:
        runs = [at[k : k + 16] for k in range(0, len(at), 16)]
        for path, i in zip(paths, where):
            run = runs[i // 16]
            path.append(("".join(run[: i % 16]), "".join(run[i % 16 + 1 :])))
        where = [i // 16 for i in where]
        at = [H("".join(r)) for r in runs]
    return paths, at[0]


def plain(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for row in rows:
        doc, *others, text = row
        bad = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0 and text is not None
        claimed = framed([doc, *others, text.translate(lower)]) if bad else framed(row)
        groups[row[1]].append((doc is not None, doc or 0, framed(row), claimed, doc))
    keys = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {k: plain_paths([r[2] for r in sorted(groups[k], key=lambda r: r[:3])]) for k in keys}
    tops, root = plain_paths([trees[k][1] for k in keys]) if keys else ([], "")
    out = []
    for k, top in zip(keys, tops):
        for (_, _, leaf, claimed, doc), path in zip(sorted(groups[k], key=lambda r: r[:3]), trees[k][0]):
            folded = claimed
            for before, after in path + top:
                folded = H(before + folded + after)
            out.append((doc, leaf, trees[k][1], root, H("".join(b + a for b, a in path + top)), folded, folded == root))
    return sorted(out, key=repr)


def proofs(docs, part):
    manifest = merkle.build(merkle.document_leaves(docs, merkle.fifth(F.col("doc_id"))), part)
    return sorted((tuple(r) for r in merkle.prove(manifest).collect()), key=repr)


def odd_rows():
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(700)] + [(5, None, None, None, None)]
    rows += [(None, None, "en", 1, "A"), (None, None, "en", 1, "a"), (7, "", "en", 1, ""), (7, "é", "en", 1, "Ünï"), (7, "é", "en", 1, "Ünï")]
    rows += [(10**12 + i, f"one{i}", "en", 1, "Lone") for i in range(40)] + [(9, "z", "en", 2, "Same")] * 40
    return rows


@pytest.mark.parametrize("part", [1, 7, 16, 50, 100_000])
def test_proofs_of_odd_rows(spark, part):
    rows = odd_rows() if part > 1 else odd_rows()[-90:]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("leaf", "part", "tree", "idx", "size", "claimed")})
    assert proofs(docs.repartition(5), part) == plain(rows)


def test_proofs_of_few_rows(spark):
    for rows in ([], [(1, "a", "en", 1, "X")], [(1, "a", "en", 1, "X"), (2, "b", "en", 1, "x")], [(None, None, None, None, None)] * 2):
        assert proofs(spark.createDataFrame(rows, SCHEMA), 3) == plain(rows)


def test_proofs_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = proofs(docs, 64)
    assert got == plain(rows) and {r[-1] for r in got} == {True, False}


def levels_of(size):
    sizes = [size]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // 16))
    return sizes


@pytest.mark.parametrize("lo,hi,size", [(0, 1, 1), (0, 1, 2), (5, 9, 300), (15, 17, 300), (0, 300, 300), (250, 300, 300), (4000, 4400, 5000), (3, 4, 70_000)])
def test_fetched_nodes_are_the_least_ones(lo, hi, size):
    """Exactly the children of all nodes above the leaves lo to hi that aren't themselves above one of them."""
    want = set()
    for level, n in enumerate(levels_of(size)[:-1]):
        above = {i >> 4 * level for i in range(lo, hi)}
        want |= {(level, c) for p in {i >> 4 for i in above} for c in range(16 * p, min(16 * p + 16, n)) if c not in above}
    got = list(merkle.missing(lo, hi, size))
    assert len(got) == len(set(got)) and set(got) == want and len(got) <= 30 * len(levels_of(size))


@pytest.mark.parametrize("cuts", [[], [1], [16], [7, 16, 40, 299], [250, 290]])
def test_frontiers_hold_what_any_partition_misses(cuts):
    """Frontiers, and the parents they give, answer every partition's fetch; a wrong or missing node does not verify."""
    digests = [H(str(i)).encode() for i in range(300)]
    edges = [0, *cuts, 300]
    nodes = {}
    for a, z in zip(edges, edges[1:]):
        nodes |= {(0, level, i): h for level, i, h in merkle.frontier(a, digests[a:z], 300)}
    for level, n in enumerate(levels_of(300)[:-1]):
        for p in range(-(-n // 16)):
            children = [nodes.get((0, level, c)) for c in range(16 * p, min(16 * p + 16, n))]
            assert all(children) or not any(children)  # a parent has all of its children there, or none
            if all(children):
                nodes[0, level + 1, p] = H(b"".join(children).decode()).encode()
    root = plain_paths([d.decode() for d in digests])[1]
    for a, z in zip(edges, edges[1:]):
        levels, derived = merkle._derive(0, a, digests[a:z], 300, nodes)
        assert derived.decode() == root
        assert all(merkle._fold(levels, i, digests[i]).decode() == root for i in range(a, z))
        assert merkle._fold(levels, a, digests[(a + 1) % 300]).decode() != root
    if cuts:
        with pytest.raises(KeyError):
            merkle._derive(0, 0, digests[: cuts[0]], 300, {})
