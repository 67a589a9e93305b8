"""Joins of wide rows with few partners: same results, and only rows that may have a partner are shuffled."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import frames, jaccard
from tests.llm.test_corpus import frame, join_of, plain_join


def shuffles(rows):
    return rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_sifted_joins_are_joins(spark, monkeypatch, how, kind):
    monkeypatch.setattr(frames, "SIEVE_BITS", (6, 8))  # many rows without a partner pass as well
    big = spark.range(400).select(F.when(F.col("id") % 9 > 0, F.col("id") % 300).cast(kind).alias("k"), F.col("id").alias("text"))
    small = spark.range(20).select(F.when(F.col("id") > 0, F.col("id") * 7 % 50 * 8).cast(kind).alias("k"))
    small = frames.settle(small if how.startswith("left_") else small.withColumn("more", F.lit("x")), "few")
    want = sorted(map(str, big.join(small, "k", how).collect()))
    for bound in (100, 3):
        got = frames.join_small(big, small, "k", how, bound, sift=True)
        assert sorted(map(str, got.collect())) == want
    none = small.where("k = 'none'") if kind == "string" else small.where("k < 0")
    assert sorted(map(str, frames.join_small(big, none, "k", how, -1, sift=True).collect())) == sorted(map(str, big.join(none, "k", how).collect()))


def test_rows_that_surely_have_no_partner_are_not_shuffled(spark, monkeypatch):
    small = frames.settle(spark.range(50), "few")
    near, apart = frames.sifted(spark.range(10_000).withColumn("text", F.lit("long")), small, "id")
    assert near.count() < 200 and near.count() + apart.count() == 10_000
    assert shuffles(apart) == shuffles(near) == 0


def test_many_first_sets(spark, monkeypatch):
    """More first documents than are told to every task: sets that no other row has are not shuffled, and the join is the same."""
    random = np.random.default_rng(5)
    text = lambda n: " ".join(f"v{w}" for w in random.integers(0, 60, n))
    rows = [(i, text(int(random.integers(0, 40)))) for i in range(60)] + [(None, "no id " * 9), (None, text(9)), (200, None), (201, "")]
    rows += [(300 + i, rows[i % 7][1]) for i in range(20)] + [rows[3], (None, rows[4][1])]
    rows += [(400 + i, " ".join([f"h{k}" for k in range(60)] + [f"own{i}"])) for i in range(30)]
    for name, value in (("LIST", 3), ("RARE_LIST", 5), ("FREQUENT_FROM", 4), ("CHUNK_COUNT", 2), ("CHUNK_KEYS", 200), ("TOLD_SETS", 0)):
        monkeypatch.setattr(jaccard, name, value)
    held, kept = [], jaccard._first_sets
    monkeypatch.setattr(jaccard, "_first_sets", lambda index, sets: held.append(kept(index, sets)) or held[-1])
    some = [r for r in rows if r[0] is not None]
    assert join_of(frame(spark, some).repartition(4), 4, 85) == plain_join(some, 4, 85)
    assert shuffles(held[0]) == 0
    none = [r for r in jaccard.similar_documents(frame(spark, rows), 4, 85).collect() if r["doc_id"] is None]
    assert len(none) == 3


def test_postings_travel_once(spark, monkeypatch):
    """The keys of sets that share few of them are shuffled in one exchange, however many they are."""
    monkeypatch.setattr(jaccard, "RARE_LIST", 5)
    held = spark.createDataFrame([(d, 9, [k * 2 + 1 for k in (d, d // 7 + 1000, 5000)]) for d in range(60)], "doc bigint, n bigint, keys array<bigint>")
    short, packed = [], jaccard.settle_packed
    monkeypatch.setattr(jaccard, "settle_packed", lambda rows, label: short.append(rows) or packed(rows, label))
    pairs, hubs = jaccard._met(held.repartition(4), 80)
    assert sorted((r["key"], r["hub"]) for r in hubs.collect()) == sorted([((d + 1000) * 2 + 1, d * 7) for d in range(8)] + [(10_001, 0)])
    assert {(r["a"], r["b"]) for r in pairs.collect()} == {(a, b) for a in range(56, 60) for b in range(a + 1, 60)}
    assert [shuffles(rows) for rows in short] == [1]


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_near_duplicates_keep_one_row_each(spark, monkeypatch, bound):
    join = corpus_pipeline.join_small
    wide = []

    def told(big, small, on, how, sift=False):
        wide.extend([sift] if "text" in big.columns else [])
        return join(big, small, on, how, bound, sift)

    monkeypatch.setattr(corpus_pipeline, "join_small", told)
    texts = [" ".join(f"t{i}w{k}" for k in range(30)) for i in range(6)]
    rows = [(i, texts[i]) for i in range(6)] + [(10, texts[0]), (2, texts[2]), (2, texts[2]), (None, texts[4]), (None, "alone " * 8), (None, "alone " * 8), (30, None), (31, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    want = [(i, texts[i]) for i in range(6)] + [(None, "alone " * 8), (30, None), (31, "")]
    assert sorted(map(str, got)) == sorted(map(str, spark.createDataFrame(want, docs.schema).collect()))
    assert wide[-2:] == [True, True]  # texts are not shuffled as a whole
