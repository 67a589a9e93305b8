"""HTML extraction, chat formatting, WARC, quality rules, packing and license scans against plain Python."""

import base64
import gzip
import hashlib
import re
import textwrap
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventloom.llm import chat, html, license, packing, quality, queries, warc
from tests.helpers import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, texts, extra=True):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return frame.withColumns({c: F.lit("x") for c in ("score", "length", "rank", "bucket", "n", "kept")}) if extra else frame


# HTML


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit(1))


def texts_of(frame):
    return {r["page_id"]: r["text"] for r in frame.collect()}


def test_article_is_kept_and_the_rest_dropped(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body>"
        "<nav><ul><li><a>Menu</a></li></ul></nav><div class='ad'>Buy</div><header><h1>Site</h1></header>"
        "<article><header><h1>Caf&eacute;  &amp;\n tea</h1></header><p><b>One<br>two<p>Th<i>re</i>e &lt;b&gt; &#8364;</p>"
        "<aside>Side</aside><form>Name <input></form><div class='cookie-notice'>We use</div><ul><li>a</li><li>b</li></ul>"
        "<section id='comments'><p>First!</p></section></article><footer>&copy; x</footer></body></html>"
    )
    got = texts_of(html.extract(pages(spark, [(1, "http://a.b/c", page), (2, None, None), (3, "http://a.b/d", ""), (1, "http://a.b/c", page)])))
    assert got == {1: "Café & tea\n\nOne two\n\nThree <b> €\n\na\n\nb", 2: "", 3: ""}


def test_truncated_page_keeps_what_it_has(spark):
    assert texts_of(html.extract(pages(spark, [(1, "http://a.b", "<article><p>One two</p><p>Three &am")]))) == {1: "One two\n\nThree &am"}


def test_runs_shared_by_pages_of_a_host_go(spark):
    bar = "Welcome to our site please read the house rules today"
    body = ["alpha beta gamma delta eps zeta", "one two three four five six seven", "red green blue black white pink brown"]
    rows = [(i, f"http://h.org/{i}", f"<body><div>{bar}</div><div>{t}</div><div>Imprint</div></body>") for i, t in enumerate(body)]
    rows += [(9, "http://other.org/", f"<body><div>{bar}</div></body>")]
    got = texts_of(html.extract(pages(spark, rows)))
    assert got == {0: body[0], 1: body[1], 2: body[2], 9: bar}
    # copies of one page count once: nothing of them is boilerplate
    same = [(i, "http://h.org/", rows[0][2]) for i in range(5)]
    assert set(texts_of(html.extract(pages(spark, same))).values()) == {f"{bar}\n\n{body[0]}\n\nImprint"}


def test_blocks_beside_an_article_meet_the_suffix_sort(spark):
    bar = "Welcome to our site please read the house rules today"
    page = "<body><div>{}</div><article><p>Teaser {}</p></article><div>{}</div></body>"
    body = [" ".join(f"body{i}w{k}" for k in range(40)) for i in range(4)]
    got = texts_of(html.extract(pages(spark, [(i, f"http://h.org/{i}", page.format(bar, i, t)) for i, t in enumerate(body)])))
    assert got == {i: f"Teaser {i}\n\n{t}" for i, t in enumerate(body)}


def test_class_tokens_count_whole_and_never_drop_an_article():
    blocks = lambda h: [t for t, _ in html.page_blocks(h)]
    article = "<article{}><h1>Title</h1><p>Text</p></article>"
    for around in ("has-sidebar", "no-sidebar", "sidebar", "page overlay"):
        assert blocks(f"<div class='{around}'>{article.format('')}</div>") == ["Title", "Text"]
    for own in ("post comments-open", "notice", "post related"):
        assert blocks(article.format(f" class='{own}'")) == ["Title", "Text"]
    inner = "<h2 id='social-impact'>Impact</h2><h2 id='search'>Search</h2><section id='related-work'><p>Work</p></section><section id='discussion'>Why</section>"
    assert blocks(f"<article>{inner}</article>") == ["Impact", "Search", "Work", "Why"]
    # still dropped: whole tokens that hold no article, and articles within an article's comments
    assert blocks("<div class='ad'>Buy</div><div class='x sidebar'>Side</div><div id='navMenu'>Go</div><p>Text</p>") == ["Text"]
    assert blocks("<article><p>Text <span class='share'>Share</span> it</p><div class='comments'><article>First!</article></div></article>") == ["Text it"]
    # undecided, not kept, inside a region of that kind
    assert html.page_blocks("<div class='sidebar'>Side<article>Text</article></div><main>Main</main>") == [("Side", False), ("Text", False), ("Main", True)]


@pytest.mark.parametrize("odd", ["<![foo]>", "<![>", "<![0]>", "<![ x>", "<![endif]>", "<![if !IE]>", "<![CDATA[x]]>", "<svg><![CDATA[</svg>]]></svg>"])
def test_odd_declarations_are_comments(odd):
    assert html.page_blocks(f"<p>a</p>{odd}<p>b</p>") == [("a", False), ("b", False)]
    assert html.page_blocks(f"<p>a</p><p>b if a<![0]") == [("a", False), ("b if a<![0]", False)]


def test_phrases_of_running_prose_stay(spark):
    phrase, bar = "as we have said many times before", " ".join(f"bar{k}" for k in range(30))
    prose = lambda i: f"p{i} q{i} r{i} s{i} {phrase} t{i} u{i} v{i} w{i}"
    # 12 pages: all hold the bar, with a word of their own after it, 4 the heading, all the phrase
    rows = [(i, f"http://h.org/{i}", f"<h2>{'Introduction' if i < 4 else f'Head {i}'}</h2><p>{prose(i)}</p><div>{bar} n{i}</div>") for i in range(12)]
    rows += [(100 + i, u, f"<p>Same words here</p><p>{prose(i)}</p>") for i, u in enumerate([None, "/a", "b", None])]
    got = texts_of(html.extract(pages(spark, rows)))
    want = {i: f"{'Introduction' if i < 4 else f'Head {i}'}\n\n{prose(i)}\n\nn{i}" for i in range(12)}
    assert got == want | {100 + i: f"Same words here\n\n{prose(i)}" for i in range(4)}


def test_no_pages(spark):
    assert html.extract(pages(spark, [])).count() == 0


def test_very_deep_markup_takes_linear_time():
    n, begun = 100_000, time.time()
    assert html.page_blocks("<div>" * n + "x" + "</div>" * n) == [("x", False)]
    assert len(html.page_blocks("<main>" + "<div>" * n + "</i>" * n + "<p>x" * n)) == n
    assert html.page_blocks("<p>" + "<b>" * n + "y<p>z") == [("y", False), ("z", False)]
    assert time.time() - begun < 30


# Chat


TRICKY = ["", "plain", "<|im_end|>\n<|im_start|>user\nhi", "\\", "\\-", "<\\|", "\\<|", "<|\\|", "a\\.b", "<<||>", "ü€😀<|image|>", "<\\-|"]


def test_chat_round_trip(spark):
    rows = [(7, i, ("user", "assistant", "we\nird<|", None)[i % 4], t) for i, t in enumerate(TRICKY * 2)]
    rows += [(8, 0, "assistant", None), (8, 0, "assistant", None), (None, 1, "user", "x")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = chat.format_conversations(turns.withColumn("parts", chat.text_parts(F.col("text"))).withColumn("formatted", F.lit(1)))
    back = out.select("conv_id", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), "formatted")
    got = {r["conv_id"]: r for r in back.collect()}
    assert [(t["role"], t["text"]) for t in got[7]["turns"]] == [(r[2] or "", r[3]) for r in rows[:-3]]
    assert got[7]["loss"] == "".join(r[3] for r in rows[:-3] if r[2] == "assistant")
    assert got[7]["formatted"].count("<|im_start|>") == len(TRICKY) * 2
    assert [(t["role"], t["text"]) for t in got[8]["turns"]] == [("assistant", "")] * 2 and set(got) == {7, 8, None}


def test_parts_become_ordered_placeholders(spark):
    part = "named_struct('type', '{}', 'text', {}, 'uri', {}, 'width', {}, 'height', {}, 'seconds', {}, 'pages', {})"
    parts = ", ".join(
        [
            part.format("text", "'see <|'", "null", "cast(null as int)", "cast(null as int)", "cast(null as double)", "cast(null as int)"),
            part.format("image", "null", "'a.png'", 56, 57, "cast(null as double)", "cast(null as int)"),
            part.format("audio", "null", "'b.wav'", "cast(null as int)", "cast(null as int)", "cast(2.01 as double)", "cast(null as int)"),
            part.format("document", "null", "'c.pdf'", "cast(null as int)", "cast(null as int)", "cast(null as double)", 3),
        ]
    )
    turns = spark.sql(f"select 1L conv_id, 0L turn, 'user' role, array({parts}) parts union all select 1L, 1L, 'assistant', null")
    row = chat.format_conversations(turns).collect()[0]
    assert row["formatted"] == "<|im_start|>user\nsee <\\|<|image|><|audio|><|document|><|im_end|>\n<|im_start|>assistant\n<|im_end|>\n"
    assert [(a["turn_position"], a["type"], a["uri"], a["tokens"]) for a in row["attachments"]] == [(1, "image", "a.png", 6), (1, "audio", "b.wav", 51), (1, "document", "c.pdf", 3072)]
    assert row["expanded_tokens"] == 6 + 51 + 3072


# WARC


def test_archives_round_trip(spark, tmp_path):
    bodies = ["<p>é</p>\r\n\r\nWARC/1.1\r\n", None, "", "same", "same", "same", "x" * 300_000, "other"]
    rows = [(i, None if i == 6 else f"http://Www.Example.org/p?{i % 3}", b) for i, b in enumerate(bodies)] + [(3, "http://www.example.org/p?0", "same")]
    for least in (0, 1):
        path = f"{tmp_path}/w{least}"
        warc.write_archives(pages(spark, rows), path, F.lit("2024-01-01T00:00:00Z"), least)
        got = warc.merge_index(warc.read_archives(spark, path)).collect()
        assert len(got) == len(rows)
        first = {}
        for i, b in sorted((r[0], r[2] or "") for r in rows):
            first.setdefault(b, i)
        for r in got:
            b = (bodies[r["page_id"]] or "").encode()
            assert r["payload_bytes"] == len(b) and r["payload_digest"] == base64.b32encode(hashlib.sha1(b).digest()).decode()
            f = first[b.decode()]
            revisit = f != r["page_id"] and len(b) >= least
            assert (r["record_type"], r["refers_to"]) == (("revisit", f) if revisit else ("response", None))
        ordered = [(r["urlkey"], r["captured_at"], r["page_id"]) for r in sorted(got, key=lambda r: r["position"])]
        assert ordered == sorted(ordered)
    assert ordered[-1][0] == "org,example,www)/p?2"


def test_records_are_fetched_by_their_bytes(spark, tmp_path):
    """Small archives, cut by bytes; a page over 16 MB, whose member ends in no zero of its own."""
    bodies = [f"<p>{i}</p>" + "ä\n\0" * (i * 50) for i in range(60)] + ["", None, "x" * (17 << 20), "<p>1</p>" + "ä\n\0" * 50]
    path = f"{tmp_path}/w"
    warc.write_archives(pages(spark, [(i, f"http://h/{i % 7}", b) for i, b in enumerate(bodies)]), path, F.lit("2024-01-01T00:00:00Z"), 1, file_bytes=2000)
    index = warc.merge_index(warc.read_archives(spark, path))
    places = defaultdict(list)
    for r in index.collect():
        places[r["archive"]].append((r["offset"], r["length"], r["urlkey"], r["page_id"]))
    assert len(places) > 8 and sum(map(len, places.values())) == len(bodies)
    for archive, members in places.items():
        members.sort()
        data = open(archive.removeprefix("file:"), "rb").read()
        assert [m[0] for m in members] + [len(data)] == [0] + [m[0] + m[1] for m in members]
        assert [m[2:] for m in members] == sorted(m[2:] for m in members)
        assert len(data) < 2100 or len(members) == 1
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") == len(members)
        for offset, length, _, page in members:
            raw = gzip.decompress(data[offset : offset + length])
            assert f"WARC-Record-ID: <urn:page:{page}>".encode() in raw and raw.endswith(b"\r\n\r\n")
    got = {r["page_id"]: (r["record_type"], bytes(r["payload"])) for r in warc.fetch_records(spark, path, index.where("page_id >= 50")).collect()}
    assert got == {i: ("response", (b or "").encode()) for i, b in enumerate(bodies) if 50 <= i < 63} | {63: ("revisit", b"")}


def test_loser_tree():
    runs = [[(1,), (4,), (4,)], [], [(0,), (4,), (9,)], [(2,)], [(4,)]]
    assert [runs[r][i] for r, i in warc.LoserTree(runs)] == sorted(x for run in runs for x in run)
    assert list(warc.LoserTree([])) == []


def test_no_archives(spark, tmp_path):
    warc.write_archives(pages(spark, []), f"{tmp_path}/w", F.lit("x"))
    assert warc.merge_index(warc.read_archives(spark, f"{tmp_path}/w")).count() == 0


# Quality


def base_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)}
    n = len(words)
    return (n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


def test_base_counts(spark):
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a a a a", "a b c a b c", "x y z\x0bw\x85v", "l 1\nl 1\n\n\nl 1\n k", "#*$ %&|<> é" * 5, "a b c d e f g " * 300, " ".join(f"w{i}" for i in range(60_000))]
    got = {r["doc_id"]: tuple(r)[1:] for r in quality.surface_counts(docs(spark, texts)).drop("words").collect()}
    assert got == {i: base_counts(t) for i, t in enumerate(texts)}
    real = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want = {r["doc_id"]: base_counts(r["text"]) for r in real.collect()}
    assert {r["doc_id"]: tuple(r)[1:] for r in quality.surface_counts(real).drop("words").collect()} == want


def test_ratio_rejects_what_is_unlike_the_trusted(spark):
    good, bad = [f"the cat sat on a mat number {i} " * 12 for i in range(40)], [f"zz{i} | qq ## buy now {i} | win " * 12 for i in range(40)]
    texts = [" ".join(f"{w}{k}" if k % 9 == 0 else w for k, w in enumerate(t.split())) for t in good + bad]
    labels = spark.createDataFrame([(i, int(i < 40), 0) for i in range(0, 80, 2)] + [(None, 1, None), (0, 1, 0)], "doc_id bigint, quality int, toxic int")
    frame = docs(spark, texts)
    ratio = quality.fit_ratio(frame, labels)
    scored = quality.surface_counts(frame).withColumn("base_failed", F.lit(False)).withColumn("score", quality.score(F.col("words"), ratio))
    threshold = quality.fit_threshold(scored, labels)
    assert {r["doc_id"] for r in scored.collect() if r["score"] >= threshold} == set(range(40))
    assert quality.fit_threshold(scored, labels.where("quality = 1")) is None
    doubled = labels.union(spark.createDataFrame([(i, 0, 0) for i in range(0, 8, 2)], labels.schema))
    lowest = labels.withColumn("quality", F.when(F.col("doc_id") < 8, 0).otherwise(F.col("quality")))
    assert quality.fit_threshold(scored, doubled) == quality.fit_threshold(scored, lowest)
    assert quality.quality(docs(spark, []), labels).count() == 0
    assert quality.quality(docs(spark, [None, "w " * 60]), labels.limit(0)).count() == 2


# Packing


def check_packed(rows, texts, length):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(queries.tokenizer_path())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, text in enumerate(texts):
        ids = coder.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        assert [x for r in pieces for x in r["ids"]] == ids
        assert all(r["doc_tokens"] == len(ids) and r["length"] == len(r["ids"]) for r in pieces)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        ends = [0]
        for r in pieces:
            assert r["offset"] == ends[-1]
            ends.append(r["offset"] + r["length"])
        assert ends[-1] <= length
    return by_sequence


def test_packing_of_the_given_documents(spark):
    frame = spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id")
    texts = [r["text"] for r in frame.collect()]
    sequences = check_packed(packing.pack(frame.repartition(5), queries.tokenizer_path()).collect(), texts, 2048)
    tokens = sum(r["length"] for s in sequences.values() for r in s)
    assert tokens / (2048 * len(sequences)) > 0.97


def test_packing_edge_cases(spark):
    texts = [None, "", "<|endoftext|> A'b it's x​ý ﬁ 123", "word " * 9000, "a", "a", "é" * 700, "日本語 text\x1cmore", "x\x00y"]
    for length in (8, 2048):
        check_packed(packing.pack(docs(spark, texts), queries.tokenizer_path(), length).collect(), texts, length)
    assert packing.pack(docs(spark, []), queries.tokenizer_path()).count() == 0


def test_shortest_pack_first():
    patterns = packing.pack_histogram({8: 2, 5: 3, 3: 3, 1: 40}, 8)
    used = Counter()
    for pattern, count in patterns:
        assert sum(pattern) <= 8
        for size in pattern:
            used[size] += count
    assert used == {8: 2, 5: 3, 3: 3, 1: 40} and sum(c for _, c in patterns) == 10


def test_crc():
    batch = pa.RecordBatch.from_arrays([pa.array([[1, 40000], []], pa.list_(pa.int32()))], ["ids"])
    assert next(packing.crc_batches([batch])).column("ids_crc32").to_pylist() == [zlib.crc32(b"\1\0\0\0\x40\x9c\0\0"), 0]


# Licenses


def test_licenses(spark):
    texts = [
        None, "", "Nothing here about a free lunch.\nAt all.",
        "Intro.\nReleased under the MIT License.\nOutro", "é\nLicensed under the Apache License,  Version 2.0.",
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY 4.0.", "This work is licensed under the GNU General Public License, version 5.",
        "licensed " * 20_000, "Our drivers are licensed to drive large vans in the city of Bern.",
    ]
    got = {r["doc_id"]: (r["start"], r["license_id"], r["confirmed"]) for r in license.scan(docs(spark, texts)).collect()}
    confirmed = {k: v[:2] for k, v in got.items() if v[2]}
    assert confirmed == {3: (7, "MIT"), 4: (2, "Apache-2.0"), 5: (0, "CC-BY-NC-4.0"), 6: (0, "CC-BY-4.0")}
    assert not got[7][2]


def test_license_notices_inside_long_lines_and_wrapped(spark):
    random = np.random.default_rng(4)
    prose = lambda n: " ".join("".join(random.choice(list("abcdefghij"), 6)) for _ in range(n))
    mit, gpl = license.TEMPLATES["MIT"][2], license.TEMPLATES["GPL-3.0"][1]
    notices = [("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), ("Released under the MIT License.", "MIT"), (mit, "MIT"), (gpl, "GPL-3.0")]
    texts = [f"{prose(500)} {n} {prose(500)}" for n, _ in notices]
    texts += [f"{prose(20)}\n{textwrap.fill(n, 70)}\n{prose(20)}" for n in (mit, gpl)]
    texts += [" * " + textwrap.fill(mit, 60).replace("\n", "\n * "), f"{prose(9)} Released under the MIT License. Licensed under CC BY 4.0. {prose(9)}"]
    got = defaultdict(list)
    for r in license.scan(docs(spark, texts)).collect():
        assert r["confirmed"] and texts[r["doc_id"]][r["start"] : r["start"] + r["length"]] == r["block"]
        got[r["doc_id"]].append((r["start"], " ".join(r["block"].split()), r["license_id"]))
    want = {i: [(texts[i].index(n), n, name)] for i, (n, name) in enumerate(notices)}
    want |= {i: [(texts[i].index(n[:10]), n, name)] for i, n, name in ((4, mit, "MIT"), (5, gpl, "GPL-3.0"))}
    assert {i: got[i] for i in want} == want
    assert [x[2] for x in got[6]] == ["MIT"] and len(got[6][0][1]) > len(mit)
    assert [x[1:] for x in sorted(got[7])] == [("Released under the MIT License.", "MIT"), ("Licensed under CC BY 4.0.", "CC-BY-4.0")]


@pytest.mark.parametrize("name", ["op1_html_extraction", "op3_warc_index", "op4_quality_rules", "op8_license_scan"])
def test_queries_run_over_whole_tables(spark, name):
    source = {"op1": "pages", "op3": "pages", "op4": "documents"}.get(name[:3])
    rows = queries.QUERIES[name](spark, SF_SMALL).count()
    assert rows == spark.read.parquet(f"{SF_SMALL}/{source}.parquet").count() if source else rows > 0
