"""Operator 12, HTML extraction: the main text of pages by their markup, and by host suffix arrays where markup does not tell.

A page is read once, tag by tag, into blocks of text. Each block is told by what encloses it: the article (article or main
elements, roles, or names of classes that stand for it), what is no part of it (menus, headers, footers, asides, forms, and
names of classes for adverts, notices, comments and the like), or neither. If a page has an article, its blocks are the
text: a passage that other pages have as well stays, as the article may be quoted or copied. All other blocks of pages that
have no article, and those beside an article within main, are decided by the host's suffix array:

The words of all blocks outside articles are a page's token stream. The streams of a host's distinct pages are concatenated, with a
separator of its own after each, and a suffix array of them shows all strings of LONG words or more that stand on two
distinct pages. Words that such strings cover are boilerplate and go; the unique runs of a block stay. Copies of a whole
page count as one page. A host of many words is dealt to shards, each with its own suffix array; what a shard has of
LONG-word strings is summed over the host's shards (the smallest and the largest page are enough to see two), so that
a string is found wherever its pages are. The array is ordered by LONG words, which is all that covering needs.

Edge cases: null and empty pages have an empty text; markup may be broken off anywhere, and elements may be left open; a null url has
no host and is one of its own; repeated rows get the same result each; an empty table gives no rows; columns with clashing names are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise

#: Words of a long string (a power of two), and words of a shard.
LONG, SHARD_WORDS = 8, 2_000_000

#: Elements that hold no text of a page, those whose content is raw, empty ones, and those that end a block.
SILENT = {"script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "audio", "video", "select", "button", "datalist", "textarea", "title", "xmp", "noembed", "noframes", "applet", "dialog", "map"}
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "noscript"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr", "keygen", "frame"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul",
}
#: Elements that a new one of some kind ends, and where the search for them stops.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
CELLS = {"td", "th"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6", "hgroup"}
#: What an element, a role or a name says of its content.
OUTSIDE = {"nav", "footer", "aside", "search", "menu"}
#: Elements whose ids are names of parts; those of headings and inline elements are often made from their text.
PARTS = {"div", "section", "ul", "ol", "table", "dl", "article"}
OUTSIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
ARTICLE_NAMES = {"article-body", "article-content", "article-text", "article__body", "articlebody", "entry-content", "post-content", "post-body", "story-body", "main-content", "page-content", "content-body"}
OUTSIDE_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "sponsor", "sponsored", "promo", "promotion", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "masthead", "footer",
    "sidebar", "aside", "widget", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "popup", "modal", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related",
    "recommended", "recommendations", "comment", "comments", "commentlist", "disqus", "respond", "reply", "replies", "pagination", "pager", "toolbar", "searchbox", "searchform", "copyright", "disclaimer", "skip",
}
NOT_AFTER = {"with", "has", "no", "non", "without", "has_", "is"}

#: Fixed value: a comment, a declaration, or a tag with its attributes; a quote counts after an equals sign only.
TAG = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')|=)*+)(?:>|\Z))""", re.DOTALL
)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
IN, OUT, HEADER, UNKNOWN, BESIDE, FORM = range(6)


def _zone(name: str, attributes: str, zone: int) -> int:
    """The zone of an element's content within a zone. Nothing leads out of what is outside, but a form may enclose a
    whole page, with its article."""
    if zone == OUT or name in OUTSIDE:
        return OUT
    found: dict[str, str] = {}
    if attributes and not attributes.isspace():
        for m in ATTRIBUTE.finditer(attributes):
            found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    role = found.get("role", "").lower()
    if role in OUTSIDE_ROLES or "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return OUT
    named: list[str] = []
    if found and name not in ("html", "body", "main"):
        named = f"{found.get('class', '')} {found.get('id', '') if name in PARTS else ''}".lower().split()
        for words in named:
            parts = re.split("[^a-z0-9]+", words)
            if any(w in OUTSIDE_NAMES and (i == 0 or parts[i - 1] not in NOT_AFTER) for i, w in enumerate(parts)):
                return OUT
    if name == "main" or role == "main":
        return IN if zone == IN else BESIDE
    if name == "article" or role == "article" or "articlebody" in found.get("itemprop", "").lower() or any(w in ARTICLE_NAMES for w in named):
        return IN
    if name == "header":
        return HEADER if zone in (IN, HEADER, BESIDE) else OUT
    return FORM if name == "form" else zone


def blocks(html: str) -> list[tuple[int, str]]:
    """(zone, text) of a page's blocks in order; texts have single spaces and are not empty."""
    out: list[tuple[int, str]] = []
    held: list[str] = []
    aside: list[str] = []  # what stands within the block but is no part of it
    stack: list[tuple[str, int]] = []  # name, and the zone around the element
    zone, silent, where = UNKNOWN, 0, UNKNOWN

    def flush() -> None:
        for of, parts in ((where, held), (OUT, aside)):
            text = " ".join("".join(parts).split())
            if text:
                out.append((of, text))
            parts.clear()

    def leave(depth: int) -> None:
        nonlocal zone, silent
        while len(stack) > depth:
            name, zone = stack.pop()
            silent -= name in SILENT
            if name in BLOCK:
                flush()
            elif name in CELLS:
                held.append(" ")

    def leave_one(names: set[str], stops: set[str]) -> bool:
        """Leaves the innermost element of these names, unless one of `stops` is further inside."""
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                leave(i)
                return True
            if stack[i][0] in stops:
                return False
        return False

    at, size = 0, len(html)
    while at < size:
        m = TAG.search(html, at)
        begin = m.start() if m else size
        if begin > at and not silent:
            now = zone
            if zone == HEADER:
                now = IN if any(s[0] in HEADINGS for s in stack) else OUT
            if now in (OUT, FORM):
                aside.append(unescape(html[at:begin]))
            else:
                if now != where:
                    if held:
                        flush()
                    where = now
                held.append(unescape(html[at:begin]))
        if m is None:
            break
        at = m.end()
        if m[2] is None:  # a comment or a declaration
            continue
        name = m[2].lower()
        if m[1]:
            if not leave_one({name}, NONE if name in BLOCK or name in CELLS else BLOCK) and name in BLOCK:
                flush()
            continue
        if name in BLOCK:
            flush()
            if name not in ("html", "body"):
                leave_one({"p"}, BLOCK - {"p"})
        elif name in CELLS or name == "br":
            held.append(" ")
            aside.append(" ")
        if name in ENDS:
            leave_one(*ENDS[name])
        if name in VOID:
            continue
        if name in RAW:
            close = _closing(name).search(html, at)
            at = close.end() if close else size
            continue
        stack.append((name, zone))
        zone = _zone(name, m[3], zone)
        silent += name in SILENT
    leave(0)
    flush()
    return out


NONE: set[str] = set()
_CLOSING: dict[str, re.Pattern] = {}


def _closing(name: str) -> re.Pattern:
    if name not in _CLOSING:
        _CLOSING[name] = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.IGNORECASE)
    return _CLOSING[name]


def page(html: str | None) -> tuple[list[str | None], bool, list[tuple[bool, str]]]:
    """The blocks that are the text by their markup, in order, with None where an undecided block stands; whether there is
    such a block; and (undecided, text) of all blocks outside articles."""
    found = blocks(html or "")
    has_article = any(z == IN for z, _ in found)
    has_main = any(z == BESIDE for z, _ in found)
    text: list[str | None] = []
    stream: list[tuple[bool, str]] = []
    for z, t in found:
        if z == IN:
            text.append(t)
            continue
        undecided = z == BESIDE or (z == UNKNOWN and not has_article and not has_main)
        if undecided:
            text.append(None)
        stream.append((undecided, t))
    return text, any(u for u, _ in stream), stream


def words_of(stream: list[tuple[bool, str]]) -> np.ndarray:
    """Hashes of the stream's words; markup does not part them."""
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for _, t in stream for w in t.split(" ")), np.uint64)


def joined(text: list[str | None], stream: list[tuple[bool, str]], covered: np.ndarray | None) -> str:
    """The text, with the words of undecided blocks that nothing covers."""
    at, kept = 0, []
    for undecided, t in stream:
        words = t.split(" ")
        if undecided:
            here = covered[at : at + len(words)] if covered is not None else np.zeros(len(words), bool)
            kept.append(" ".join(w for w, gone in zip(words, here, strict=True) if not gone))
        at += len(words)
    rest = iter(kept)
    return "\n\n".join(t for t in (next(rest) if t is None else t for t in text) if t)


def suffix_order(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of numbers from 0, by their first `depth` (a power of two) places, and each suffix's rank: those
    with equal ranks agree in all of them. Prefix doubling."""
    rank, n, width = tokens.astype(np.int64), len(tokens), 1
    order = np.argsort(rank, kind="stable")
    while width < depth and n:
        behind = np.zeros(n, np.int64)
        behind[: max(0, n - width)] = rank[width:] + 1
        pair = rank * (int(rank.max()) + 2 if n else 1) + behind
        order = np.argsort(pair, kind="stable")
        rank = np.zeros(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], np.diff(pair[order]) != 0]))
        width *= 2
    return order, rank


def long_strings(streams: list[np.ndarray], pages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array's groups of suffixes that share LONG words, of streams whose pages are told by a number each: the
    places of all such suffixes in the concatenated streams, the group of each, and for each group a hash of its words,
    its smallest and its largest page."""
    lengths = np.fromiter(map(len, streams), np.int64, len(streams))
    flat = np.concatenate(streams) if streams else np.zeros(0, np.uint64)
    _, numbers = np.unique(flat, return_inverse=True)
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    tokens = np.zeros(int((lengths + 1).sum()), np.int64)
    of = np.repeat(np.arange(len(streams)), lengths)
    tokens[np.arange(len(flat)) + of] = numbers
    tokens[starts + lengths] = len(flat) + np.arange(len(streams))  # separators, which no two suffixes share
    order, rank = suffix_order(tokens, LONG)
    owner = np.repeat(np.arange(len(streams)), lengths + 1)
    left = np.repeat(starts + lengths, lengths + 1) - np.arange(len(tokens))  # words up to the separator
    order = order[left[order] >= LONG]
    if not len(order):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), none, none
    group = np.cumsum(np.concatenate([[0], np.diff(rank[order]) != 0]))
    first = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])
    holders = pages[owner[order]]
    places = order - owner[order]  # in flat
    h = np.zeros(len(first), np.uint64)
    for i in range(LONG):
        h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ flat[places[first] + i]
        h = h ^ (h >> np.uint64(29))
    return places, group, h, np.minimum.reduceat(holders, first), np.maximum.reduceat(holders, first)


def covered_words(streams: list[np.ndarray], pages: np.ndarray, repeated: np.ndarray) -> list[np.ndarray]:
    """Which words of each stream stand in a string of LONG words whose hash is in `repeated`."""
    lengths = np.fromiter(map(len, streams), np.int64, len(streams))
    places, group, h, _, _ = long_strings(streams, pages)
    hit = places[np.isin(h, repeated)[group]]
    total = int(lengths.sum())
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + LONG, -1)
    inside = np.cumsum(edge)[:total] > 0
    return np.split(inside, np.cumsum(lengths)[:-1])


def _host(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else ""


PARSED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("text", pa.string()), ("html", pa.string()), ("stream_id", pa.int64())])
STREAMS = pa.schema([("host", pa.string()), ("stream_id", pa.int64()), ("n_words", pa.int64()), ("undecided", pa.bool_()), ("stream", pa.binary())])


def _rows(batch: pa.RecordBatch, of: pa.Schema) -> pa.RecordBatch:
    rows = []
    for page_id, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
        text, undecided, stream = page(html)
        words = words_of(stream).tobytes()
        told = xxhash.xxh3_64_intdigest(words) >> 1
        if of is STREAMS:
            rows.append((_host(url), told, len(words) // 8, undecided, words))
        else:  # a page with undecided blocks is read again when they are decided
            rows.append((page_id, url, _host(url), None if undecided else joined(text, stream, None), html if undecided else None, told))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(of), of, strict=True)], schema=of)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _rows(batch, PARSED)


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield _rows(batch, STREAMS)


def _strings(table: pa.Table) -> pa.Table:
    """Of a shard: its long strings by hash, with their smallest and largest page."""
    streams = [np.frombuffer(b, np.uint64) for b in table.column("stream").to_pylist()]
    _, _, h, low, high = long_strings(streams, table.column("stream_id").to_numpy())
    return pa.table({"host": pa.array([table.column("host")[0].as_py()] * len(h), pa.string()), "shard": pa.array(np.full(len(h), table.column("shard")[0].as_py()), pa.int64()), "h": pa.array(h.view(np.int64)), "low": pa.array(low), "high": pa.array(high)})


def _covered(shard: pa.Table, strings: pa.Table) -> pa.Table:
    """Of a shard's streams: how many of their words are covered, and where blocks are to be decided, which (a byte for each)."""
    ids = shard.column("stream_id").to_numpy()
    streams = [np.frombuffer(b, np.uint64) for b in shard.column("stream").to_pylist()]
    inside = covered_words(streams, ids, strings.column("h").to_numpy().view(np.uint64)) if streams else []
    asked = shard.column("undecided").to_pylist()
    return pa.table(
        {
            "host": pa.array(shard.column("host").to_pylist(), pa.string()),
            "stream_id": pa.array(ids, pa.int64()),
            "n_repeated": pa.array([int(x.sum()) for x in inside], pa.int64()),
            "covered": pa.array([x.astype(np.uint8).tobytes() if u else None for x, u in zip(inside, asked, strict=True)], pa.binary()),
        }
    )


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for i, (html, covered) in enumerate(zip(batch.column("html").to_pylist(), batch.column("covered").to_pylist(), strict=True)):
            if html is not None:
                text, _, stream = page(html)
                texts[i] = joined(text, stream, None if covered is None else np.frombuffer(covered, np.uint8) > 0)
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), batch.column("n_repeated")], ["page_id", "url", "text", "n_repeated"])


def coverage(streams: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """host, stream_id, n_repeated and covered of distinct streams: the host's suffix arrays. streams: host, stream_id,
    n_words, undecided and stream."""
    distinct = streams.filter("n_words > 0").groupBy("host", "stream_id")
    streams = materialise(distinct.agg(F.any_value("n_words").alias("n_words"), F.max("undecided").alias("undecided"), F.any_value("stream").alias("stream")), "streams")
    hosts = streams.groupBy("host").agg(F.ceil(F.sum("n_words") / shard_words).alias("shards"))
    dealt = streams.join(hosts, "host").withColumn("shard", F.pmod(F.xxhash64("stream_id"), F.col("shards"))).drop("shards", "n_words")
    strings = materialise(dealt.groupBy("host", "shard").applyInArrow(_strings, "host string, shard long, h long, low long, high long"), "strings")
    repeated = strings.groupBy("host", "h").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("host", "h")
    back = strings.select("host", "shard", "h").join(repeated, ["host", "h"])
    pairs = dealt.groupBy("host", "shard").cogroup(back.groupBy("host", "shard"))
    return pairs.applyInArrow(_covered, "host string, stream_id long, n_repeated long, covered binary")


def main_texts(pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html", shard_words: int = SHARD_WORDS) -> DataFrame:
    """page_id, url, text, n_chars and n_repeated (words outside articles that the host's pages repeat) of every page."""
    rows = pages.select(F.col(page_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    found = materialise(coverage(map_batches(rows, _streams, "host string, stream_id long, n_words long, undecided boolean, stream binary"), shard_words), "covered")
    parsed = map_batches(rows, _parsed, "page_id long, url string, host string, text string, html string, stream_id long")
    held = parsed.join(found, ["host", "stream_id"], "left").select("page_id", "url", "text", "html", "covered", F.coalesce("n_repeated", F.lit(0).cast("long")).alias("n_repeated"))
    out = map_batches(held, _decided, "page_id long, url string, text string, n_repeated long")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_repeated")
