"""Phrase collocations against plain Python."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, least, top, covered=80):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(words)
            f.update((lang, words[i : i + k]) for k in (1, 2, 3, 4) for i in range(len(words) - k + 1))
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    gone = {
        (lang, w[i : i + m])
        for (lang, w), b in candidates.items()
        for m in range(2, len(w))
        for i in range(len(w) - m + 1)
        if 100 * b >= covered * f[lang, w[i : i + m]]
    }
    scored = defaultdict(list)
    for (lang, w), a in candidates.items():
        if (lang, w) not in gone:
            cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            scored[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted(
        (lang, rank, p.decode(), -a, left, right, n[lang], -s)
        for lang, rows in scored.items()
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)
    )


def texts():
    random = np.random.default_rng(2)
    vocabulary = ["the", "The", "of", "New", "york", "new", "é", "日本", "a-b", "x\x00", "O'Neil", "ß", " q", "big"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", " . ", "\r\n", "\x0b", ""]
    rows = []
    for i in range(120):
        size = int(random.integers(0, 60))
        words = random.choice(vocabulary, size, p=np.r_[[0.3, 0.1], np.full(12, 0.05)])
        rows.append(((None, "und", "en", "", "日本")[i % 5], "".join(w + e for w, e in zip(words, random.choice(ends, size)))))
    rows += [("en", None), ("en", ""), (None, None), ("fr", " .,;"), ("en", "again and again " * 3000), ("en", "alone " * 29)] + [("de", "eins zwei drei vier fünf")] * 40
    return rows


@pytest.mark.parametrize("least,top,trie", [(30, 2000, 1_000_000), (3, 7, 40), (300, 5, 1)])
def test_collocations_of_odd_texts(spark, monkeypatch, least, top, trie):
    monkeypatch.setattr(phrases, "TRIE", trie)
    monkeypatch.setattr(phrases, "SKETCH_BITS", (8 if least == 3 else 14, 16))
    docs = spark.createDataFrame(texts(), "lang string, text string").withColumns({c: F.lit("x") for c in ("key", "phrase", "n", "f", "k", "doc_id")})
    got = sorted(tuple(r) for r in phrases.collocations(docs.repartition(6), least, top).collect())
    want = plain(texts(), least, top)
    assert got == want and want


def test_collocations_of_nothing(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).count() == 0
    assert phrases.collocations(spark.createDataFrame([("en", "one two"), (None, None)], none.schema)).count() == 0


def test_scores_pass_64_bits(spark, monkeypatch):
    big = 6_000_000_000_000_000_000
    rows = [("en", "a b", 2, big), ("en", "a", 1, big), ("en", "b", 1, big + 5)]
    found = spark.createDataFrame(rows, "lang string, phrase string, k int, f bigint")
    totals = spark.createDataFrame([("en", 2 * big % 2**62)], "lang string, n bigint")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda docs, least: (found, totals))
    (row,) = phrases.collocations(None).collect()
    assert row["score"] == 2_000_000 * big // (2 * big + 5)


@pytest.mark.parametrize("count,words", [(0, 1), (1, 1), (50, 3), (5000, 40), (20_000, 3000)])
def test_tries_accept_their_phrases_only(count, words):
    random = np.random.default_rng(count)
    made = {tuple(random.integers(1, words + 1, int(random.integers(2, 5))) ** 2) for _ in range(count)}
    rows = sorted(made)
    paths, lengths = np.zeros((len(rows), 4), np.uint64), np.array([len(r) for r in rows], np.int64)
    for i, r in enumerate(rows):
        paths[i, : len(r)] = r
    trie = phrases.build_trie(paths, lengths)
    number = {r: i for i, r in enumerate(rows)}
    place = {int(s): i for i, s in enumerate(trie.symbols)}
    others = [tuple(random.integers(1, words + 1, int(random.integers(1, 5))) ** 2) for _ in range(500)]
    for phrase in rows[:2000] + others:
        state = np.zeros(1, np.int64)
        for word in phrase:
            state = trie.step(state, np.array([place.get(int(word), -1)])) if state[0] >= 0 else state
        assert (trie.number[state[0]] if state[0] >= 0 else -1) == number.get(phrase, -1)
    assert len(trie.check) <= phrases.ROOMY * (4 * len(rows) + 1) + 20 * len(trie.symbols) + 20


def test_a_full_sketch_only_lets_more_pass(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SKETCH_BITS", (6, 6))
    docs = spark.createDataFrame(texts(), "lang string, text string")
    found, _ = phrases.frequent_phrases(docs, 30)
    assert sorted(tuple(r) for r in phrases.collocations(docs, 30, 2000).collect()) == plain(texts(), 30, 2000)
    assert found.where("f < 30").count() == 0


def test_candidates_follow_the_frequent_phrases(spark, monkeypatch):
    """However many different phrases there are: few of those that are not frequent pass."""
    random = np.random.default_rng(8)
    rows = [("en", " ".join(f"w{i}" for i in random.integers(0, 20_000, 600))) for _ in range(150)] + [("de", "eins zwei drei vier")] * 3
    kept, settle = {}, phrases.settle

    def keep(frame, label):
        kept[label] = settle(frame, label)
        return kept[label]

    monkeypatch.setattr(phrases, "settle", keep)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = sorted(tuple(r) for r in phrases.collocations(docs, 2, 500).collect())
    assert got == plain(rows, 2, 500) and len(got) > 0
    assert kept["phrase-candidates"].where("k > 1").count() < 150 * 600 / 5


def test_counters_of_tasks_add_up(spark, monkeypatch):
    monkeypatch.setattr(phrases, "COUNTERS", 40)
    monkeypatch.setattr(phrases, "SLICE", 200)
    docs = spark.createDataFrame(texts(), "lang string, text string").repartition(3)
    assert sorted(tuple(r) for r in phrases.collocations(docs, 30, 2000).collect()) == plain(texts(), 30, 2000)


@pytest.mark.parametrize("sample,told", [(1, 1_000_000), (2, 5), (2, 1_000_000), (10**9, 7)])
def test_candidates_of_a_sample_are_not_sent_again(spark, monkeypatch, sample, told):
    monkeypatch.setattr(phrases, "SAMPLE", sample)
    monkeypatch.setattr(phrases, "TOLD", told)
    sent, settle = {}, phrases.settle

    def keep(frame, label):
        sent[label] = settle(frame, label)
        return sent[label]

    monkeypatch.setattr(phrases, "settle", keep)
    docs = spark.createDataFrame(texts(), "lang string, text string").repartition(5)
    assert sorted(tuple(r) for r in phrases.collocations(docs, 3, 2000).collect()) == plain(texts(), 3, 2000)
    first, rest = ({r["key"] for r in sent[c].collect()} for c in ("told-candidates", "other-candidates"))
    assert len(first) <= told and not first & rest and (rest == set()) == (sample == 1)
