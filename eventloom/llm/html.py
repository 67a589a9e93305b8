"""Main text of HTML pages: block structure first, then a host-wide suffix array over what it leaves open.

Text inside an article (or main) element is kept; navigation, forms, notices and the like are dropped
by element, role and class. Blocks outside both are undecided, also on pages that have an article: their
word streams are concatenated per host and suffixes are sorted by their first words. Windows of words that
a good part of the host's distinct pages share are boilerplate where they make up a long run or nearly all
of a block; all else stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.frames import join_small, settle
from eventloom.llm.words import mix

RUN = 6  # words of a window
LONG_RUN = 20  # words of a run of shared windows that goes from any block
NEARLY = 0.8  # of a block's words in shared windows: these go, however short
PAGES_AT_ONCE = 500  # pages whose blocks a task holds
SUFFIXES_AT_ONCE = 50_000  # suffix rows a task holds
MIN_PAGES = 3  # distinct pages that share a window
MIN_SHARE = 0.5  # of the host's distinct pages that share it
_STEP = np.uint64(0xD6E8FEB86659FD93)

# Elements without an end tag, elements that begin a block, elements without main text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol optgroup option p pre section summary table tbody td"
    " tfoot th thead tr ul caption".split()
)
_DROP = frozenset(
    "head title script style noscript template nav footer aside form button select option textarea input label"
    " svg math iframe object embed canvas audio video map dialog menu datalist fieldset".split()
)
_DROP_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
_DROP_WORD = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent"
    " gdpr notice notices popup modal overlay sidebar menu nav navbar navigation breadcrumb breadcrumbs footer"
    " masthead comment comments reply replies disqus respond discussion share sharing social related recommended newsletter"
    " subscribe subscription signup login search widget toolbar pagination pager skip".split()
)
# Class or id tokens of several words that are dropped besides those made of the words above alone.
_DROP_TOKEN = frozenset(
    "related-posts related-articles comments-area comments-section comments-list comment-list comment-form share-buttons"
    " social-links site-footer page-footer site-nav site-navigation main-nav main-menu main-navigation ad-slot ad-container"
    " ad-unit cookie-bar newsletter-form search-form login-form disqus-thread".split()
)
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
_BOXES = frozenset("div ul ol dl table".split())  # whose ids count inside an article
_SECTION_IDS = frozenset("comment comments disqus disqus-thread".split())  # ids of a section inside an article that count
_CLOSES_P = _BLOCK - {"html", "body"}
_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[A-Za-z]+")


def _dashed(token: str) -> str:
    return "-".join(n.lower() for n in _NAME.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", token)))


def _drop_token(token: str) -> bool:
    name = _dashed(token)
    return bool(name) and (name in _DROP_TOKEN or all(n in _DROP_WORD for n in name.split("-")))


class _Open(NamedTuple):
    """An open element and what holds there."""

    tag: str
    dropped: bool  # by element, role or style, here or above
    region: int  # innermost region dropped by class or id, or -1
    inside: bool  # an article or main
    in_article: bool

    @property
    def kept(self) -> bool:
        return self.inside and not self.dropped and self.region < 0


_TOP = _Open("", False, -1, False, False)


class _Blocks(HTMLParser):
    """Blocks of text in page order: (text, inside an article or main).

    An element that a class or an id drops is a region. A region that turns out to hold an article or main
    is not dropped: its blocks, those of the article too, are undecided. Within an article it stays dropped,
    as an article in an article is a comment or teaser.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[_Open] = []
        self.places: dict[str, list[int]] = {}  # of the open elements of a name in the stack
        self.blocks: list[int] = []  # places of the open block elements
        self.text: list[tuple[str, int, bool]] = []  # piece, region, kept
        self.pieces: list[list[tuple[str, int, bool]]] = []  # of each block
        self.regions: list[tuple[int, bool]] = []  # region around it, whether it holds an article

    def _flush(self) -> None:
        if self.text:
            self.pieces.append(self.text)
            self.text = []

    def _drops(self, tag: str, values: dict[str, str], inside: bool) -> bool:
        if tag in _DROP or (tag == "header" and not inside):
            return True
        if "hidden" in values or values.get("aria-hidden", "").lower() == "true":
            return True
        if re.search(r"display\s*:\s*none", values.get("style", ""), re.I):
            return True
        return values.get("role", "").lower() in _DROP_ROLE

    def _named(self, tag: str, values: dict[str, str], inside: bool) -> bool:
        """Whether a class or the id, taken whole, names something else than main text."""
        if tag in ("html", "body", "main"):
            return False
        if any(_drop_token(t) for t in values.get("class", "").split()):
            return True
        name = values.get("id", "").strip()
        if not name or tag in _HEADING:
            return False
        if inside and tag not in _BOXES:
            return tag == "section" and _dashed(name) in _SECTION_IDS
        return _drop_token(name)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in _BLOCK:
            self._flush()
            if tag in _CLOSES_P and self.places.get("p") and self.places["p"][-1] == self.blocks[-1]:
                self._close(self.blocks[-1])  # an open paragraph ends; inline elements left open end with it
        elif tag == "br":
            self._add(" ")
        if tag in _VOID:
            return
        values = {k: (v or "") for k, v in attrs}
        _, dropped, region, inside, in_article = self.stack[-1] if self.stack else _TOP
        dropped = dropped or self._drops(tag, values, inside)
        opens = tag in ("article", "main") or values.get("role") in ("main", "article")
        if not dropped and self._named(tag, values, inside):
            self.regions.append((region, False))
            region = len(self.regions) - 1
        if opens and not dropped and not in_article:
            around = region
            while around >= 0 and not self.regions[around][1]:
                self.regions[around] = (self.regions[around][0], True)
                around = self.regions[around][0]
        in_article = in_article or tag == "article" or values.get("role") == "article"
        self.places.setdefault(tag, []).append(len(self.stack))
        if tag in _BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(_Open(tag, dropped, region, inside or opens, in_article))

    def _close(self, place: int) -> None:
        """End the element at this place of the stack and all within it."""
        while len(self.stack) > place:
            tag = self.stack.pop().tag
            self.places[tag].pop()
            if tag in _BLOCK:
                self.blocks.pop()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and tag not in ("svg", "math"):
            return  # HTML ignores the slash on other elements
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in _BLOCK:
            self._flush()
        if self.places.get(tag):
            self._close(self.places[tag][-1])

    def parse_html_declaration(self, i: int) -> int:
        """As HTML has it, '<![' begins a comment up to '>', but for CDATA in svg and math."""
        if not self.rawdata.startswith("<![", i):
            return super().parse_html_declaration(i)
        if self.rawdata.startswith("<![CDATA[", i) and (self.places.get("svg") or self.places.get("math")):
            end = self.rawdata.find("]]>", i)
            return end + 3 if end >= 0 else -1
        return self.parse_bogus_comment(i)

    def handle_data(self, data: str) -> None:
        self._add(data)

    def _add(self, data: str) -> None:
        top = self.stack[-1] if self.stack else _TOP
        if not top.dropped:
            self.text.append((data, top.region, top.kept))

    def _block(self, pieces: list[tuple[str, int, bool]]) -> tuple[str, bool]:
        held = [p for p in pieces if p[1] < 0 or self.regions[p[1]][1]]
        text = _SPACE.sub(" ", "".join(p[0] for p in held)).strip()
        return text, any(kept for piece, _, kept in held if not piece.isspace())

    def result(self, html: str) -> list[tuple[str, bool]]:
        self.feed(html)
        self.close()
        self._flush()
        return [b for b in map(self._block, self.pieces) if b[0]]


def page_blocks(html: str | None) -> list[tuple[str, bool]]:
    """Text blocks of one page with whether an article or main element holds them; the others are undecided.

    Null or empty html has no blocks.
    """
    return _Blocks().result(html) if html else []


def _pieces(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    for at in range(0, len(frame), PAGES_AT_ONCE):
        yield frame.iloc[at : at + PAGES_AT_ONCE]


def _parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in (f for frame in frames for f in _pieces(frame)):
        blocks = [page_blocks(h) for h in frame["html"]]
        yield frame.drop(columns="html").assign(
            texts=[[t for t, _ in b] for b in blocks], kept=[[bool(k) for _, k in b] for b in blocks]
        )


def _suffix_names(words: list[str], width: int) -> np.ndarray:
    """A name for the first `width` words of each suffix of a block; a shorter block has one for all of it."""
    codes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    width = min(width, len(codes))
    named = np.full(len(codes) - width + 1, width, np.uint64)
    for k in range(width):
        named = mix(named * _STEP + codes[k : len(codes) - width + 1 + k])
    return named.view(np.int64)


def _suffix_rows(held: list[tuple[str, int, int, np.ndarray]]) -> pd.DataFrame:
    hosts, pages, blocks, names = zip(*held)
    sizes = [len(n) for n in names]
    return pd.DataFrame(
        {
            "host": np.repeat(np.array(hosts, object), sizes),
            "name": np.concatenate(names),
            "row": np.repeat(np.array(pages, np.int64), sizes),
            "block": np.repeat(np.array(blocks, np.int32), sizes),
            "at": np.concatenate([np.arange(n, dtype=np.int32) for n in sizes]),
        }
    )


def _suffixes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        held, size = [], 0
        for host, page, texts, kept in zip(frame["host"], frame["row"], frame["texts"], frame["kept"]):
            for block, (text, keep) in enumerate(zip(texts, kept)):
                if keep:
                    continue
                held.append((host, page, block, _suffix_names(text.split(" "), RUN)))
                size += len(held[-1][3])
                if size >= SUFFIXES_AT_ONCE:
                    yield _suffix_rows(held)
                    held, size = [], 0
        if held:
            yield _suffix_rows(held)


def _unique_runs(text: str, starts: set[int]) -> str:
    if not starts:
        return text
    words = text.split(" ")
    runs: list[list[int]] = []  # of windows that begin at one word after another
    for s in sorted(starts):
        if runs and runs[-1][1] == s - 1:
            runs[-1][1] = s
        else:
            runs.append([s, s])
    spans = [range(a, min(z + RUN, len(words))) for a, z in runs]
    covered = {i for span in spans for i in span}
    if len(covered) < NEARLY * len(words):
        covered = {i for span in spans if len(span) >= LONG_RUN for i in span}
    return " ".join(w for i, w in enumerate(words) if i not in covered)


def _join(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in (f for frame in frames for f in _pieces(frame)):
        out = []
        for texts, kept, repeated in zip(frame["texts"], frame["kept"], frame["repeated"]):
            starts: dict[int, set[int]] = {}
            for r in repeated if repeated is not None else ():
                starts.setdefault(r["block"], set()).add(r["at"])
            blocks = [text if keep else _unique_runs(text, starts.get(i, set())) for i, (text, keep) in enumerate(zip(texts, kept))]
            out.append("\n\n".join(b for b in blocks if b))
        yield frame[["page_id", "url"]].assign(text=out)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url and the main text of every page.

    The text inside an article or main element stays whole. The undecided blocks of all pages, also those
    beside an article, stay without repeats: windows of RUN words (or whole shorter blocks) that at least
    MIN_PAGES distinct pages and MIN_SHARE of the host's distinct pages share, if they are a run of LONG_RUN
    words or nearly all of the block. A page whose url has no host shares with no other page. Pages with equal text count as one page, so a page is not lost for having
    copies. A null or empty html, or a page of boilerplate only, has an empty text; repeated rows stay.
    """
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    parsed = settle(
        rows.withColumn("row", F.monotonically_increasing_id()).mapInPandas(
            _parse, "page_id bigint, url string, host string, row bigint, texts array<string>, kept array<boolean>"
        ).withColumns({"content": F.xxhash64("texts"), "undecided": F.size(F.filter("kept", lambda k: ~k))}),
        "blocks",
    )
    open_pages = parsed.where("undecided > 0 and host <> ''")
    suffixes = open_pages.mapInPandas(_suffixes, "host string, name bigint, row bigint, block int, at int")
    suffixes = settle(suffixes.join(open_pages.select("row", "content"), "row"), "suffixes")
    sizes = settle(
        parsed.where("host <> '' and size(texts) > 0").groupBy("host").agg(F.count_distinct("content").alias("of")), "hosts"
    )
    counts = suffixes.groupBy("host", "name").agg(F.count_distinct("content").alias("pages"))
    shared = (
        join_small(counts.where(F.col("pages") >= MIN_PAGES), sizes, "host", "inner")
        .where(F.col("pages") >= MIN_SHARE * F.col("of"))
        .select("host", "name")
    )
    repeated = (
        suffixes.join(shared, ["host", "name"], "left_semi")
        .groupBy("row")
        .agg(F.collect_list(F.struct("block", "at")).alias("repeated"))
    )
    whole = parsed.drop("content", "undecided").join(repeated, "row", "left")
    return whole.mapInPandas(_join, "page_id bigint, url string, text string")
