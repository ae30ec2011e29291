"""Operator 12: the main text of pages."""

import itertools
import os
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seqsieve.llm import html_text

LONG = html_text.LONG


def text_of(html):
    text, _, stream = html_text.page(html)
    return html_text.joined(text, stream, None)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<nav>menu</nav><article><h1>A &amp; B</h1><p>one\n two<br>three<p>four <b>bold</b>est</article><footer>end</footer>", "A & B\n\none two three\n\nfour boldest"),
        ("<article><p>a<!-- x > y --><script>if (a<b) '</p>'</script>b</p><style>p{}</style></article>", "ab"),
        ('<article><p title="a > b">kept</p><div class="ad">buy</div><aside>more</aside><form><p>mail</form><p>also</p></article>', "kept\n\nalso"),
        ('<body class="with-sidebar"><div class="site-header">top</div><article class="post no-sidebar"><header><h1>T</h1><p>by me</p></header><p>x</p><section id="comments"><article><p>first!</p></article></section></article>', "T\n\nx"),
        ("<form><div><article><p>a page in a form</p></article></div></form>", "a page in a form"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>1<td>2<tr><td>3</table></article>", "a\n\nb\n\n1 2\n\n3"),
        ("<article><p>in a <span class='share'>tweet it</span> sentence &#x41;&copy &nbsp; &unknown; &am", "in a sentence A© &unknown; &am"),
        ("<article><p>1 < 2 and <3 <p class=x>cut off <a href='", "1 < 2 and <3\n\ncut off"),
        ("<ARTICLE><P>upper</P></ARTICLE><article><p>second</p></article>", "upper\n\nsecond"),
        ("<article><p hidden>no</p><div style='display: none'>no</div><div role='navigation'>no</div><h2 id='menu'>Menu</h2></article>", "Menu"),
        ("<main><header><h1>Title</h1></header><p>body</p></main>", "Title\n\nbody"),
        ("<div class='entry-content'><p>blog</p></div><div>rest</div>", "blog"),
        ("<p>no article</p>plain", "no article\n\nplain"),
        ("<article><svg><text>no</text></svg><button>no</button><noscript><p>no</noscript><textarea>no</textarea>yes</article>", "yes"),
        ("<article>a<hr>b<b><p>c</b>d</p></article>", "a\n\nb\n\ncd"),
        ("", ""),
        (None, ""),
        ("<article></article>", ""),
        ("no markup at all", "no markup at all"),
        ("<p " * 3000, ""),
        ('<a b="' * 3000, ""),
        ("<!--" * 3000, ""),
    ],
)
def test_markup(html, text):
    assert text_of(html) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<article>", "</article>", "<p>", "</p>", "<div class='ad'>", "</div>", "<nav>", "</nav>", "<!--", "-->", "<script>", "</script>", "<", ">", '"', "a='", "w ", "&lt;", "<li>", "</ul>", "<td>"]), max_size=25).map("".join))
def test_any_markup_is_read(html):
    words = html_text.words_of(html_text.page(html)[2])
    assert len(words) == sum(len(t.split(" ")) for _, t in html_text.page(html)[2])
    text_of(html)


def plain_covered(streams):
    """Words of each stream in strings of LONG words that another stream has too."""
    holders = {}
    for i, s in enumerate(streams):
        for p in range(len(s) - LONG + 1):
            holders.setdefault(tuple(s[p : p + LONG]), set()).add(i)
    out = []
    for s in streams:
        inside = [False] * len(s)
        for p in range(len(s) - LONG + 1):
            if len(holders[tuple(s[p : p + LONG])]) > 1:
                inside[p : p + LONG] = [True] * LONG
        out.append(inside)
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=30), min_size=1, max_size=5, unique_by=tuple))
def test_suffix_array_finds_repeats(lists):
    streams = [np.array(x, np.uint64) for x in lists]
    order, rank = html_text.suffix_order(np.concatenate([streams[0], [7]]).astype(np.int64), 64)
    whole = [*map(int, streams[0]), 7]
    assert list(order) == sorted(range(len(whole)), key=lambda i: whole[i:])
    pages = np.arange(len(streams), dtype=np.int64)
    _, _, h, low, high = html_text.long_strings(streams, pages)
    got = html_text.covered_words(streams, pages, h[low < high])
    assert [list(x) for x in got] == plain_covered(lists)


def site():
    """Pages of three hosts that have no article: what repeats on a host goes."""
    r = random.Random(4)
    new = itertools.count()
    say = lambda n: " ".join("w%d" % next(new) for _ in range(n))
    rows, expected = [], {}
    for host in range(3):
        notice, lead, odd = say(12), say(9), say(7)
        for n in range(30):
            own = [say(r.randint(1, 25)) for _ in range(3)]
            html = f"<div>{notice}</div><div><p>{own[0]}</p><p>{own[1]} {lead}</p></div><i>{own[2]}</i><div>{odd}</div>"
            i = host * 100 + n
            rows.append((i, f"https://Host{host}.example/{n}", html))
            expected[i] = [*own, odd]  # fewer words than a long string has
    return rows, expected


def brute_texts(rows):
    parsed = [(i, html_text._host(u), html_text.page(h)) for i, u, h in rows]
    out = {}
    for host in {p[1] for p in parsed}:
        here = [p for p in parsed if p[1] == host]
        lists = [[w for _, t in p[2][2] for w in t.split(" ")] for p in here]
        distinct = list({tuple(x) for x in lists})
        covered = dict(zip(distinct, plain_covered(distinct), strict=True))
        for (i, _, (text, _, stream)), words in zip(here, lists, strict=True):
            mask = np.array(covered[tuple(words)], bool)
            t = html_text.joined(text, stream, mask)
            out.setdefault(i, []).append((t, len(t), int(mask.sum())))
    return out


def test_hosts_repeats_go_and_unique_runs_stay(spark):
    rows, own = site()
    rows += [(900, "https://host0.example/copy", rows[0][2]), (900, None, "<p>alone</p>"), (None, "x", None), (901, "https://host1.example/a", ""), (902, "https://host2.example/b", "<article>" + rows[210 - 150][2] + "</article>")]
    pages = spark.createDataFrame([(*r, "s", "h", "c") for r in rows], "page_id long, url string, html string, stream string, host string, covered string").repartition(3)
    brute = brute_texts(rows)
    for shard in (html_text.SHARD_WORDS, 120):  # one suffix array for a host, and many
        got = {}
        for r in html_text.main_texts(pages, shard_words=shard).collect():
            got.setdefault(r["page_id"], []).append((r["text"], r["n_chars"], r["n_repeated"]))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in brute.items()}
    for i, parts in own.items():
        if i != 0:  # the page that was copied counts once
            assert brute[i][0][0] == "\n\n".join(parts)
    assert html_text.main_texts(pages.limit(0)).count() == 0


def test_query_gives_the_articles(spark, small):
    import html as library
    import re

    from seqsieve.llm.queries import op12_main_texts

    if not os.path.exists(f"{small}/pages.parquet"):
        pytest.skip("no pages")
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in op12_main_texts(spark, small).collect()}
    assert got.keys() == pages.keys()
    for i, h in pages.items():
        article = re.search("<article>(.*?)</article>", h, re.DOTALL)[1].replace("<br>", " ")
        parts = [" ".join(library.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article)]
        text = "\n\n".join(filter(None, parts))
        assert got[i]["text"] == text and got[i]["n_chars"] == len(text)
