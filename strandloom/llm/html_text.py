"""HTML extraction: a host suffix array finds boilerplate, markup corrects it.

A page becomes a stream of text blocks. The token streams of a host's pages are put together, the text inside article or
main left out; words that a run of LONG or more words covers which occurs on another page of the host are boilerplate. The
suffixes at content-chosen anchors of ANCHOR words are ordered to the right and, reversed, to the left, and neighbouring
common-prefix lengths give the classes of equal runs (repeats.py, suffix_dedup.py); a host with most of the pages is dealt
by anchors, crowded ones by longer stretches. A stream's end counts as words that are the same on all pages, so short
last blocks are found as well; a page of fewer than LONG words has no repeat of its own.

A block goes if COVER percent of its words are covered; unique runs stay. Repeats alone cannot give right results: copies of
an article on one host would vanish, and a footer with a text of its own would stay. So blocks inside article or main stay;
where a page has them, all other blocks go; and blocks inside named zones (navigation, footers, adverts, forms, reader
comments and the like) go everywhere.

Null or empty html gives empty text. A null url counts as one host. Rows that share or lack a page_id are pages of their
own by their url and html; equal rows each get the same result and are one page to the array. A very long page makes a
step of its own. Other columns are not looked at. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import repeats, suffix_dedup, textkit
from .common import arrow_map, id_key, stored

LONG, ANCHOR, COVER = 6, 3, 80
#: Stands for the end of a stream; no word contains it.
END = " ".join(["\x00"] * (LONG - 1))

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)"
    r"|<(script|style|noscript|template|textarea|title|svg|iframe|select|button)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>"
    r"|<[!?][^>]*>",
    re.S | re.I,
)
_MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Elements that begin a block, hold others, or are never content.
BLOCKS = frozenset("address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
CONTAINERS = frozenset("address article aside blockquote body details dialog div dl fieldset figure footer form head header main menu nav ol section table ul".split())
SPACES = frozenset("br td th wbr option".split())
DROPPED = frozenset("aside dialog footer form head menu nav".split())
#: Words of class, id and role names of what is not the article, and words that only place or shape it.
NAMES = frozenset("ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert alerts sidebar aside menu menus nav navbar navigation breadcrumb breadcrumbs footer foot masthead topbar comment comments commentlist respond reply replies disqus share sharing social related recommended newsletter subscribe subscription popup modal overlay widget widgets complementary contentinfo search login signup signin register form forms toolbar pagination pager".split())
SHAPES = frozenset("reader readers user users visitor visitors guest site page global main primary secondary left right top bottom upper lower inner outer wrap wrapper container box list item items block area section panel bar link links button buttons icon icons post posts article articles content body title heading count thread field fields input image img text label and of to sticky fixed float mobile desktop small large big js slot unit google the".split())
CONTENT, PLAIN, OUT = 2, 1, 0


def out_of_article(name: str, parent: int) -> bool:
    """Whether a class, id or role name says nothing but what is not the article: `reader-comments`, not `share-price-history`."""
    parts = re.sub(r"(?<=[a-z])(?=[A-Z])", "-", name).lower().replace("side-bar", "sidebar").replace("pop-up", "popup")
    parts = [x for x in re.split(r"[-_\d]+", parts) if x]
    names = NAMES if parent == CONTENT else NAMES | {"header"}
    return any(x in names for x in parts) and all(x in names or x in SHAPES for x in parts)


def zone_of(tag: str, attributes: str, parent: int) -> int:
    if parent == OUT or tag in DROPPED or tag == "header" and parent != CONTENT:
        return OUT
    if attributes and tag not in ("html", "body"):
        for m in _MARKS.finditer(attributes):
            if any(out_of_article(x, parent) for x in (m[1] or m[2] or m[3] or "").split()):
                return OUT
    return CONTENT if tag in ("article", "main") else parent


def blocks(html: str | None) -> list[tuple[str, int]]:
    """(text, zone) of each block with text, in page order."""
    out: list[tuple[str, int]] = []
    parts: list[str] = []
    stack: list[tuple[str, int]] = [("", PLAIN)]

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            parts.clear()
            if text:
                out.append((text, stack[-1][1]))

    html = html or ""
    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            parts.append(html[at : m.start()])
        at = m.end()
        if m[3] is None:
            continue
        tag = m[3].lower()
        if tag in SPACES:
            parts.append(" ")
        elif tag in BLOCKS:
            flush()
            if tag not in CONTAINERS:
                continue
            if not m[2]:
                if not m[4].endswith("/"):
                    stack.append((tag, zone_of(tag, m[4], stack[-1][1])))
            elif any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
    parts.append(html[at:])
    flush()
    return out


def symbols(texts: list[str | None]) -> Iterator[tuple[int, repeats.Symbols]]:
    for first, codes, offsets in textkit.steps(texts):
        a, b = textkit.words(codes)
        edges = np.searchsorted(a, offsets)
        yield first, repeats.Symbols(textkit.hashes(codes, a, b), edges[:-1], edges[1:])


def pack(values: np.ndarray) -> bytes:
    """Words as eight bytes each, so that the order of bytes is one of words."""
    return np.ascontiguousarray(values).astype(">u8").tobytes()


def look(group: np.ndarray, left: list[bytes], right: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """For each l, the class of the run of LONG words that starts l words before the anchor; -1 where the stream has none."""
    n = len(group)
    lrows, lsize = suffix_dedup.matrix(left, 8 * (LONG - ANCHOR))
    rrows, rsize = suffix_dedup.matrix(right, 8 * LONG)
    lorder, rorder = suffix_dedup.deep_shallow(lrows, group, 16), suffix_dedup.deep_shallow(rrows, group, 32)
    lshared, rshared = suffix_dedup.common_prefixes(lrows, lsize, group, lorder), suffix_dedup.common_prefixes(rrows, rsize, group, rorder)
    of_left, of_right = np.empty(n, np.int64), np.empty(n, np.int64)
    for before in range(LONG - ANCHOR + 1):
        after = LONG - before
        of_left[lorder] = np.cumsum(lshared < 8 * before)
        of_right[rorder] = np.cumsum(rshared < 8 * after)
        yield before, np.where((lsize >= 8 * before) & (rsize >= 8 * after), of_left * (n + 1) + of_right, -1)


SEARCH = repeats.Search("html", symbols, ANCHOR, LONG, pack, repeats.by_classes(look, LONG, True), elsewhere=True)


def streams(pages: DataFrame) -> DataFrame:
    """doc and sub (the page), salt (its host) and text: the words of its blocks outside article and main, and the end."""

    def run(docs, subs, salts, htmls):
        texts = ["\n".join(t for t, z in blocks(html) if z != CONTENT) for html in htmls]
        return {"doc": docs, "sub": subs, "salt": salts, "text": [f"{t}\n{END}" if t.count(" ") + t.count("\n") + 1 >= LONG else "" for t in texts]}

    host = F.lower(F.coalesce(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1), F.lit("")))
    rows = pages.select(id_key("page_id").alias("doc"), F.xxhash64("url", "html").alias("sub"), F.xxhash64(host).alias("salt"), "html")
    return arrow_map(rows, run, "doc long, sub long, salt long, text string")


def decided(found: list[tuple[str, int]], stretches: list | None) -> tuple[list[str], int]:
    """The blocks that stay, and how many the array found to be boilerplate."""
    marked = any(z == CONTENT for _, z in found)
    runs, at, kept, repeated = repeats.merged(stretches, 1 << 40), 0, [], 0
    for text, zone in found:
        if zone == CONTENT:
            kept.append(text)
            continue
        n = text.count(" ") + 1
        held = sum(max(0, min(b, at + n) - max(a, at)) for a, b in runs)
        at += n
        if 100 * held >= COVER * n:
            repeated += 1
        elif zone == PLAIN and not marked:
            kept.append(text)
    return kept, repeated


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page, and n_boilerplate, the blocks that the host suffix array found repeated."""
    stretches = repeats.covered(stored(streams(pages), "streams"), SEARCH).select(F.col("doc").alias("s_doc"), F.col("sub").alias("s_sub"), "stretches")
    keyed = pages.select("page_id", "url", "html", id_key("page_id").alias("doc"), F.xxhash64("url", "html").alias("sub"))

    def parsed(ids, urls, docs, subs, htmls):
        found = [blocks(h) for h in htmls]
        return {"page_id": ids, "url": urls, "doc": docs, "sub": subs, "texts": [[t for t, _ in f] for f in found], "zones": [[z for _, z in f] for f in found]}

    rows = arrow_map(keyed.select("page_id", "url", "doc", "sub", "html"), parsed, "page_id long, url string, doc long, sub long, texts array<string>, zones array<int>")
    rows = rows.join(stretches, (F.col("doc") == F.col("s_doc")) & (F.col("sub") == F.col("s_sub")), "left")

    def run(ids, urls, texts, zones, stretches):
        made = [decided(list(zip(t, z, strict=True)), s) for t, z, s in zip(texts, zones, stretches, strict=True)]
        joined = ["\n".join(k) for k, _ in made]
        return {"page_id": ids, "url": urls, "text": joined, "n_chars": [len(t) for t in joined], "n_boilerplate": [n for _, n in made]}

    return arrow_map(rows.select("page_id", "url", "texts", "zones", "stretches"), run, "page_id long, url string, text string, n_chars long, n_boilerplate long")
