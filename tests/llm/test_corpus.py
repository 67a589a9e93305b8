"""Decontamination, suffix dedup, LM scores, the Jaccard join and the pipeline against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import decontam, graph, jaccard, lm, quality, queries, suffix
from tests.helpers import SF_SMALL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text, width, short=True):
    w = words(text)
    if len(w) < width:
        return {tuple(w)} if w and short else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def frame(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs.withColumns({c: F.lit("x") for c in ("key", "n", "spans", "found", "row", "a", "b", "kept", "lang")})


def real(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


# Components


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(7, 7), (5, 3), (3, 5), (3, 9), (200, 201)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {3: 3, 5: 3, 9: 3, 200: 200, 201: 200}
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# Jaccard join


def plain_join(rows, width, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, shingles(t, width))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(set)
    for i, s in sets.items():
        for token in s:
            held[token].add(i)
    for a in sets:
        for b in {j for token in sets[a] for j in held[token] if j > a}:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(shingles(t, width)), find(i)) for i, t in rows)


def join_of(docs, width, percent):
    return sorted(tuple(r) for r in jaccard.similar_documents(docs, width, percent).collect())


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80)])
def test_join_of_the_given_documents(spark, width, percent):
    assert join_of(real(spark), width, percent) == plain_join(rows_of(real(spark)), width, percent)


def test_join_of_hot_groups(spark, monkeypatch):
    """Long keys, stars, blocks and combinations, with sets around all limits."""
    for name, value in (("LIST", 3), ("RARE_LIST", 5), ("BLOCK", 4), ("FREQUENT_FROM", 4), ("CHUNK_COUNT", 2), ("LONG", 60)):
        monkeypatch.setattr(jaccard, name, value)
    random = np.random.default_rng(3)
    rows = [(0, None), (1, ""), (2, "One"), (3, "one"), (4, "one two"), (5, "a b c d e f"), (6, "A b c d e f g"), (6, "A b c d e f g")]
    for base in range(4):
        text = [f"w{base}x{i}" for i in range((20, 58, 70, 150)[base])]
        for copy in range(14):
            some = list(text)
            for at in random.integers(0, len(some), int(random.integers(0, 4))):
                some[at] = f"e{base}y{copy}z{at}"
            rows.append((100 * base + 10 + copy, " ".join(some[: len(some) - copy % 3])))
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [(900 + i, f"{passage} " + " ".join(f"q{i}r{k}" for k in range(i * 3))) for i in range(12)]
    assert join_of(frame(spark, rows), 4, 85) == plain_join(rows, 4, 85)


@pytest.mark.parametrize("told", [500_000, 0])
def test_near_copies_have_one_row_for_each_hub(spark, monkeypatch, told):
    """However many long keys sets share: rows do not grow with sets times keys."""
    for name, value in (("LIST", 3), ("RARE_LIST", 5), ("FREQUENT_FROM", 4), ("CHUNK_COUNT", 2)):
        monkeypatch.setattr(jaccard, name, value)
    monkeypatch.setattr(jaccard, "LONG_KEYS", told, raising=False)
    kept, settle = {}, jaccard.settle
    monkeypatch.setattr(jaccard, "settle", lambda rows, label: kept.setdefault(label, settle(rows, label)))
    rows = [(c, " ".join([f"w{i}" for i in range(90)] + [f"own{c}"] * (c % 9))) for c in range(40)]
    rows += [(100 + c, " ".join(f"x{i if i != c else c + 500}" for i in range(90))) for c in range(0, 80, 2)]
    assert join_of(frame(spark, rows), 5, 80) == plain_join(rows, 5, 80)
    pairs = [(r["a"], r["b"]) for r in kept["stars"].collect()]
    assert pairs and len(pairs) == len(set(pairs))


def test_join_of_nothing(spark):
    assert join_of(frame(spark, []), 4, 85) == []
    assert join_of(frame(spark, [(1, None), (2, None)]), 4, 85) == [(1, 0, 1), (2, 0, 2)]


# Suffix dedup


def plain_cut(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for (doc, _), b in zip(rows, texts):
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out)


def cut_of(docs, length):
    rows = suffix.remove_repeats(docs, length).collect()
    return sorted((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), bytes(r["kept"])) for r in rows)


@pytest.mark.parametrize("order", [2, 3, 5, 7, 11, 13])
def test_difference_cover(order):
    v, cover = suffix.difference_cover(order)
    assert len(cover) == order + 1 and {(a - b) % v for a in cover for b in cover} == set(range(v))


@pytest.mark.parametrize("length", [13, 40, 400])
def test_cut_of_made_texts(spark, length, monkeypatch):
    monkeypatch.setattr(suffix, "BUCKET_BYTES", 4096)
    random = np.random.default_rng(length)
    noise = lambda n: "".join(random.choice(list("abcdefghié€"), n))
    rows = [(0, None), (1, ""), (2, "x" * (length - 1)), (3, "y" * length), (4, "z" * (length + 1)), (5, "ab" * 2 * length)]
    passages = [noise(length + d) for d in (-1, 0, 1, 7, 3 * length)]
    rows += [(10 + i, noise(i * 5) + passages[i % 5] + noise(i * 3) + passages[(i + 1) % 5]) for i in range(30)]
    rows += [(60 + i, rows[10][1]) for i in range(3)] + [(60, rows[10][1])]
    assert cut_of(frame(spark, rows).repartition(5), length) == plain_cut(rows, length)


def test_cut_of_the_given_documents(spark):
    got, want = cut_of(real(spark), 400), plain_cut(rows_of(real(spark)), 400)
    assert got == want and sum(r[2] for r in got) > 0
    assert cut_of(frame(spark, []), 400) == []


def test_names_that_share_their_top_bytes_all_reach_a_bucket(monkeypatch):
    hashes = suffix.span_hashes
    monkeypatch.setattr(suffix, "span_hashes", lambda *a: hashes(*a) & np.uint64(0xFFFFFFFF))
    random = np.random.default_rng(9)
    texts = ["".join(random.choice(list("abcdefgh"), n)) for n in (900, 700)]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(texts)], ["doc_id", "text"])
    rows = [r for b in suffix._sample(400, 5)([batch]) for r in b.to_pylist()]
    v, cover = suffix.difference_cover(11)
    sampled = {(i + 1, p) for i, t in enumerate(texts) for p in range(len(t) - 400 + v) if p % v in cover}
    sent, settled = (
        [e for r in rows if r["done"] == done for e in zip(*(x.tolist() for x in suffix._pairs(r["docs"], r["counts"], r["positions"])))]
        for done in (False, True)
    )
    assert sorted(sent) == sorted(sampled) and not settled


def test_clean_texts_lose_whole_characters_only(spark):
    passage = "€" * 40
    out = {r["doc_id"]: r["text"] for r in suffix.without_repeats(frame(spark, [(1, "a" + passage + "b"), (2, passage[:-1] + "c"), (3, None)]), 101).collect()}
    assert out == {1: "a€b", 2: "c", 3: None} or out == {1: "ab", 2: "c", 3: None}


# Decontamination


def test_leaks_in_the_given_documents(spark):
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"], r["item_shingles"], r["common"]) for r in decontam.contaminated(real(spark), items).collect()}
    want = set()
    for item, text in ((r["item_id"], r["text"]) for r in items.collect()):
        q = shingles(text, 5, False)
        for doc, t in rows_of(real(spark)):
            common = len(q & shingles(t, 5))
            if q and 100 * common >= 80 * len(q):
                want.add((doc, item, len(q), common))
    assert got == want and want


def test_leaks_of_all_sizes(spark, monkeypatch):
    monkeypatch.setattr(decontam, "ITEMS_AT_ONCE", 7)
    random = np.random.default_rng(5)
    text = lambda n, tag: " ".join(f"{tag}{k}" for k in random.integers(0, 10**9, n))
    items = [(n, text(n, "i")) for n in (5, 6, 9, 12, 13, 20, 40, 100, 300, 1000)] + [(1, "too short"), (2, None), (3, "")]
    docs, want = [(0, None), (1, ""), (2, "too short")], set()
    for i, (n, t) in enumerate(items[:10]):
        for place in (0, 1, 7, 500, 20_000):
            doc = 100 * i + place % 97 + 10
            docs.append((doc, text(place, "d") + " " + t.upper().replace(" ", "\n") + " " + text(60, "d")))
            want.add((doc, n))
        broken = t.split()
        broken[n // 2 :: 3] = ["changed"] * len(broken[n // 2 :: 3])
        docs.append((100 * i + 99, text(50, "d") + " " + " ".join(broken)))
    schema = "item_id bigint, text string"
    found = decontam.contaminated(frame(spark, docs), spark.createDataFrame(items + items[:1], schema)).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got == want and len(found) == len(got)
    assert decontam.contaminated(frame(spark, docs), spark.createDataFrame([], schema)).count() == 0
    assert decontam.contaminated(frame(spark, []), spark.createDataFrame(items, schema)).count() == 0


def test_shortest_items_are_never_missed(spark):
    items = [f"a{i} b{i} c{i} d{i} e{i}" for i in range(3000)]
    index = decontam.ItemIndex(list(range(3000)), items, 5)
    docs = pa.array([f"{t} " + " ".join(f"{t[:4]}x{k}" for k in range(40)) for t in items], pa.large_string())
    assert index.candidates(*decontam._rolled(docs, 5)) == {(i, i) for i in range(3000)}
    known = spark.createDataFrame([(None, "One two three four five six"), (7, None)], "item_id bigint, text string")
    found = decontam.contaminated(frame(spark, [(1, "zero one two three four five six"), (2, "one two")]), known)
    assert [tuple(r) for r in found.collect()] == [(1, None, 2, 2, 1.0)]


# Language model


def test_scores_of_the_given_documents(spark):
    rows = {r["doc_id"]: r for r in lm.score_documents(real(spark)).collect()}
    texts = dict(rows_of(real(spark)))
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    counts = Counter(w for i, t in texts.items() if i not in held for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    base = score = 0.0
    for i, t in texts.items():
        r, tokens = rows[i], [*words(t), None]
        want = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i in held, len(tokens), sum(counts[w] > 0 for w in tokens), n)
        assert math.isclose(r["base_score"], want, rel_tol=1e-9)
        if i in held:
            base, score = base + want, score + r["score"]
    assert score > base * 0.95 or score > base + 0.2 * sum(rows[i]["n_tokens"] for i in held)


def test_joined_tokens_score_alike(spark, monkeypatch):
    docs = frame(spark, [(i, f"The cat{i % 3} sat on\nmat{i} {'x' * (i % 5)}") for i in range(60)] + [(60, None), (61, ""), (None, "the cat"), (1, "again")])
    monkeypatch.setattr(lm, "HEAD", 3)
    want = sorted(map(tuple, lm.score_documents(docs).collect()), key=repr)
    monkeypatch.setattr(lm, "KNOWN", 5)
    got = sorted(map(tuple, lm.score_documents(docs).collect()), key=repr)
    assert len(got) == 64 and [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want])
    assert lm.score_documents(frame(spark, [])).count() == 0


def test_probabilities_sum_to_one():
    total, types = np.array([10.0] + [0.0] * 255), np.array([4.0] + [0.0] * 255)
    voc = lm.Vocabulary(np.arange(1, 40, dtype=np.uint64), np.log(np.full(39 + 256, 1 / 295)), total, types)
    a, b, z = lm.Model(voc).tables()
    assert np.allclose(np.exp(a[:, None, :] + b[None] - z[..., None]).sum(axis=2), 1, atol=1e-4)
    known = np.array([4, 3, 2, 1]) - lm.DISCOUNT
    assert math.isclose((known.sum() + lm.DISCOUNT * 4 + 1) / 11, 1)


# Pipeline


def test_pipeline_against_a_plain_version(spark):
    documents = real(spark)
    final = corpus_pipeline.run(spark, SF_SMALL).collect()
    verdict = {r["doc_id"]: r["kept"] for r in quality.quality(documents, spark.read.parquet(f"{SF_SMALL}/labels.parquet")).collect()}
    rows = [(i, t) for i, t in rows_of(documents) if verdict[i]]
    firsts = {i for i, _, c in plain_join(rows, 5, 80) if i == c}
    rows = [(i, t) for i, t in rows if i in firsts]
    rows = [(r[0], r[4].decode("utf-8", "ignore")) for r in plain_cut(rows, corpus_pipeline.PASSAGE_BYTES)]
    items = [shingles(r["text"], 5, False) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    rows = [(i, t) for i, t in rows if not any(q and 100 * len(q & shingles(t, 5)) >= 80 * len(q) for q in items)]
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(queries.tokenizer_path())
    pieces = defaultdict(list)
    for r in sorted(final, key=lambda r: (r["doc_id"], r["start"])):
        pieces[r["doc_id"]] += r["ids"]
    assert dict(pieces) == {i: coder.encode(t, add_special_tokens=False).ids + [1] for i, t in rows}
    assert 0 < len(rows) < documents.count()


def test_stages_keep_the_columns_and_survive_odd_rows(spark, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, keys string, sequence_id int"
    good = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(1, good, "en", "s", 1, "x", 1), (1, good, "en", "s", 1, "x", 1), (2, None, None, None, None, None, None), (None, good + " z", "en", "s", 2, None, 3), (3, good + " y" * 3, "en", "s", 3, None, 4)], schema)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, str(tmp_path))
            assert out.schema.simpleString() == docs.schema.simpleString(), name
            assert out.count() <= rows.count()
        assert corpus_pipeline.packed_sequences(spark, rows, str(tmp_path)).count() == rows.count()
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [1, 2]


def test_rows_without_an_own_id_have_their_own_verdict(spark, tmp_path):
    text = lambda tag, n=80: " ".join(f"{tag}{i}" for i in range(n))
    passage = text("shared", 90)
    docs = spark.createDataFrame(
        [(None, text("a")), (None, "junk"), (1, text("b")), (1, text("c")), (1, "short"), (None, text("b") + " x"), (2, text("d") + " " + passage), (None, text("e", 300) + " " + passage), (None, text("leak")), (3, text("f"))],
        "doc_id bigint, text string",
    )
    spark.read.parquet(f"{SF_SMALL}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(9, text("leak", 30))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at, seen = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = spark.createDataFrame(stage(spark, at, str(tmp_path)).collect(), docs.schema)
        seen.append(sorted(((r["doc_id"] or 0, r["text"].split()[0], len(r["text"].split())) for r in at.collect())))
    good = sorted([(0, "a0", 80), (1, "b0", 80), (1, "c0", 80), (0, "b0", 81), (2, "d0", 170), (0, "e0", 390), (0, "leak0", 80), (3, "f0", 80)])
    assert seen[0] == good
    assert seen[1] == [r for r in good if r != (0, "b0", 81)]
    assert [r[:2] for r in seen[2]] == [r[:2] for r in seen[1]] and all(r[2] < 301 for r in seen[2])
    assert seen[3] == [r for r in seen[2] if r[1] != "leak0"]


def test_passages_of_51_words_are_cut(spark):
    random = np.random.default_rng(8)
    word = lambda: "".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), int(random.choice([2, 3, 4, 5, 6, 7]))))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(51) for _ in range(30)]
    docs = [(2 * i + k, f"{text(120)} {passages[i]} {text(90)}") for i in range(30) for k in (0, 1)] + [(100 + i, text(200)) for i in range(20)]
    cut = dict(rows_of(corpus_pipeline.repeated_passages(spark, spark.createDataFrame(docs, "doc_id bigint, text string").repartition(16), "")))
    for i, t in docs:
        if i < 60:
            assert passages[i // 2] not in cut[i] and len(t) - len(cut[i]) <= len(passages[i // 2]) + 6
        else:
            assert cut[i] == t


def without_characters(text, length, counts):
    """text without the characters that lie wholly in repeated strings of `length` bytes."""
    data = text.encode()
    gone = bytearray(len(data))
    for i in range(len(data) - length + 1):
        if counts[data[i : i + length]] > 1:
            gone[i : i + length] = b"\1" * length
    at = np.cumsum([0] + [len(c.encode()) for c in text])
    return "".join(c for c, a, z in zip(text, at[:-1], at[1:]) if not all(gone[a:z]))


@pytest.mark.parametrize("short, length", [(13, 14), (40, 101), (240, 400)])
def test_two_lengths_in_one_search(spark, short, length, monkeypatch):
    monkeypatch.setattr(suffix, "BUCKET_BYTES", 4096)
    random = np.random.default_rng(short)
    noise = lambda n: "".join(random.choice(list("abcdefghijklmnop"), n)) + "é€"
    passages = [noise(n - 2) for n in (short - 4, short, short + 1, length - 6, length - 1, length, 3 * length)]
    rows = [(0, None), (1, ""), (2, "x" * short), (3, "z" * (length + 1)), (4, "ab" * length), (5, noise(short)), (6, noise(length))]
    rows += [(10 + i, noise(i * 5) + passages[i % 7] + noise(i * 3) + passages[(i + 1) % 7]) for i in range(40)]
    rows += [(60, rows[5][1]), (61, rows[6][1]), (62, rows[12][1]), (62, rows[12][1]), (63, "q" + rows[6][1])]
    rows += [(70, noise(9) + passages[6][:-1] + "€" + noise(9)), (71, passages[1] + noise(9) + passages[1])]
    docs = frame(spark, rows).repartition(5)
    found = suffix.remove_repeats(docs, length, short).collect()
    got = sorted((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), bytes(r["kept"])) for r in found)
    assert got == plain_cut(rows, length)
    texts = [(t or "").encode() for _, t in rows]
    counts = Counter(b[i : i + short] for b in texts for i in range(len(b) - short + 1))
    want = sorted((d, without_characters(t or "", short, counts)) for d, t in rows)
    assert sorted((r["doc_id"], r["text"]) for r in found) == want
    assert all(r["n_passage_bytes"] == r["n_bytes"] - len(r["text"].encode()) for r in found)


def test_passages_under_400_bytes_are_in_the_further_columns(spark, tmp_path):
    random = np.random.default_rng(4)
    word = lambda: "".join(random.choice(list("abcdefghijklmnopqrstuvwxyz"), int(random.choice([2, 3, 4, 5, 6, 7]))))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(52) for _ in range(20)]
    docs = [(2 * i + k, f"{text(120)} {passages[i]} {text(90)}") for i in range(20) for k in (0, 1)] + [(100 + i, text(200)) for i in range(20)]
    frame(spark, docs).repartition(16).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in queries.QUERIES["op7_suffix_dedup"](spark, str(tmp_path)).collect()}
    assert max(len(p) for p in passages) < 398
    for i, t in docs:
        r = rows[i]
        assert r["n_removed"] == 0 and r["kept_sha256"] == hashlib.sha256(t.encode()).hexdigest()  # the contract's 400 bytes
        if i < 40:
            assert passages[i // 2] not in r["text"] and len(passages[i // 2]) <= r["n_passage_bytes"] <= len(passages[i // 2]) + 6
        else:
            assert r["text"] == t and r["n_passage_bytes"] == 0


def test_digest_columns(spark):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op7_suffix_dedup"](spark, SF_SMALL).collect()}
    for doc, size, removed, spans, kept in plain_cut(rows_of(real(spark)), 400):
        r = rows[doc]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (size, removed, spans, hashlib.sha256(kept).hexdigest())
