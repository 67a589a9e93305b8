"""Chunk-wise BPE against the tokenizers library on whole texts."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm import chunk_bpe, queries
from eventloom.llm.words import buffer_of
from tests.helpers import SF_SMALL

PATH = queries.tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def made_texts():
    random = np.random.default_rng(4)
    alphabet = [*"abcdefgh'", " ", " ", "  ", "\n", "\t ", "é", "日本", "’s", "'ll", "12", "<|endoftext|>", "<|endof", "!?", " ", " ", "🙂", "\x1c", "\r\n"]
    noise = lambda n: "".join(random.choice(alphabet, n))
    passages = [noise(n) for n in (300, 900, 4000)] + ["the same words again and again " * 60, "x" * 3000, "日本語" * 900]
    texts = [None, "", " ", "\n\n  ", "a", "<|endoftext|>", "<|endoftext|>" * 40, " " * 5000, "word " * 40_000, noise(60_000)]
    texts += [noise(int(random.integers(0, 80))) + passages[i % 6] + noise(int(random.integers(0, 80))) + passages[(i * 5 + 1) % 6] for i in range(40)]
    return texts + texts[10:14] * 3


def check(library, docs, frame):
    got = sorted(((r["doc_id"] if r["doc_id"] is not None else -1, tuple(r["ids"])) for r in frame.collect()))
    want = sorted((-1 if i is None else i, tuple(library.encode(t or "", add_special_tokens=False).ids)) for i, t in docs)
    assert got == want


@pytest.mark.parametrize("hot", [20_000, 4])
def test_ids_are_the_librarys(spark, library, monkeypatch, hot):
    monkeypatch.setattr(chunk_bpe, "HOT", hot)
    docs = [(i if i % 9 else None, t) for i, t in enumerate(made_texts())] + [(3, "twice"), (3, "twice")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("fp", "check", "chunk", "ids", "refs", "n", "row_id")})
    check(library, docs, chunk_bpe.encode(frame.repartition(5), PATH))


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert chunk_bpe.encode(none, PATH).count() == 0
    assert [tuple(r) for r in chunk_bpe.encode(spark.createDataFrame([(1, None)], none.schema), PATH).collect()] == [(1, [])]


def test_chunks_follow_the_content():
    passage = " ".join(f"word{i * 7919 % 1000}" for i in range(2000)).encode()
    found = []
    for before in (b"", b"something else before it ", "é".encode() * 333):
        data, offsets = buffer_of(pa.array([(before + passage).decode()]))
        found.append({int(s) - len(before) for s in chunk_bpe.chunk_starts(data, offsets)})
    inside = [{s for s in f if s > 32} for f in found]
    assert inside[0] == inside[1] == inside[2] and 10 < len(inside[0]) < 80


def test_shared_chunks_are_encoded_once(spark, monkeypatch):
    text = " ".join(f"word{i * 7919 % 1000}" for i in range(2000))
    docs = spark.createDataFrame([(i, f"start{i} {text} end{i}") for i in range(8)], "doc_id bigint, text string").repartition(4)
    kept = {}
    for name, keep in (("settle", chunk_bpe.settle), ("settle_packed", chunk_bpe.settle_packed)):
        monkeypatch.setattr(chunk_bpe, name, lambda frame, label, keep=keep: kept.setdefault(label, keep(frame, label)))
    chunk_bpe.encode(docs, PATH)
    shared, cores, rows = kept["shared-chunks"], kept["chunk-ids"], kept["split-documents"].where("chunk is null")
    assert shared.count() == cores.count() > 5
    assert all(len(r["ids"]) < 3000 for r in rows.collect())  # of about 20,000 bytes of ids, the ends and the joins


def test_decoding(spark, library):
    docs = [(i, t) for i, t in enumerate(made_texts())]
    encoded = chunk_bpe.encode(spark.createDataFrame(docs, "doc_id bigint, text string"), PATH)
    assert sorted(map(tuple, chunk_bpe.decode(encoded, PATH).collect())) == [(i, t or "") for i, t in docs]
    coder = chunk_bpe.Coder(PATH)
    for ids in ([200, 201, 50256, 300], [161, 162, 163, 220], list(range(150, 256)), [50256] * 2):
        assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_digests_of_the_given_documents(spark, library):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op13_chunk_bpe"](spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    for r in docs:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
        assert tuple(rows[r["doc_id"]])[1:] == want
    assert len(rows) == len(docs)


def test_texts_may_be_cut_at_any_point_of_agreement(library, monkeypatch):
    coder = chunk_bpe.Coder(PATH)
    for text in made_texts()[-52:-12]:
        data, offsets = buffer_of(pa.array([text]))
        points = chunk_bpe.agreements(data)
        ends = np.r_[points, len(data)]
        parts, sizes = coder.encode([data[a:z].tobytes().decode() for a, z in zip(np.r_[0, points], ends)])
        assert parts.tolist() == library.encode(text, add_special_tokens=False).ids and sizes.sum() == len(parts)
        monkeypatch.setattr(chunk_bpe, "PIECE", 100)
        pieces, counts = chunk_bpe._pieces(offsets[:-1], offsets[1:], points)
        assert counts.sum() == len(pieces) and [a for a, _ in pieces] == [0, *(z for _, z in pieces[:-1])] and pieces[-1][1] == len(data)


def test_words_are_encoded_once(library, monkeypatch):
    """Every span has the library's ids; a word met before is not encoded again."""
    coder, texts = chunk_bpe.Coder(PATH), [t or "" for t in made_texts()] + ["été déjà\xa0 été\u2003 déjà\x85 là ", "ночь и ночь "]
    data, offsets = buffer_of(pa.array(texts))
    points, encoded, encode = chunk_bpe.agreements(data), [], coder.encode
    monkeypatch.setattr(coder, "encode", lambda some: encoded.extend(some) or encode(some))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    for together in (1 << 17, 50):
        monkeypatch.setattr(chunk_bpe, "TOGETHER", together)
        ids, sizes = coder.encode_spans(data.tobytes(), offsets[:-1], offsets[1:], points)
        assert sizes.tolist() == list(map(len, want)) and ids.tolist() == [i for w in want for i in w]
        assert 0 < sum(len(t.encode()) for t in encoded) < len(data) / 2
        encoded_before, encoded[:] = list(encoded), []
        coder.encode_spans(data.tobytes(), offsets[:-1], offsets[1:], points)
        assert encoded_before and not encoded
        coder._forget()
        monkeypatch.setattr(chunk_bpe, "KNOWN", 1 << 20)
    monkeypatch.setattr(chunk_bpe, "KNOWN", 20)
    again, _ = coder.encode_spans(data.tobytes(), offsets[:-1], offsets[1:], points)
    assert again.tolist() == ids.tolist()


def test_words_that_a_token_crosses_stop_the_job(monkeypatch):
    coder = chunk_bpe.Coder(PATH)
    with pytest.raises(ValueError, match="crosses"):
        coder.encode_joined([b" a", b"b"])
