import html
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tideline.llm import page_wrappers as pages


def plain(page):
    """The article's blocks of a well-formed page of the given tables."""
    if not page or "<article>" not in page:
        return ""
    article = page[page.index("<article>") + 9 : page.index("</article>")]
    texts = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article))
    return "\n".join(t for t in texts if t)


def test_given_pages(spark):
    table = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/pages.parquet")
    got = {r.page_id: r for r in pages.page_texts(table).collect()}
    rows = table.collect()
    assert len(got) == len(rows)
    for row in rows:
        assert got[row.page_id].text == plain(row.html) and got[row.page_id].n_chars == len(plain(row.html))


RICH = """<!doctype html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="page">
<header><a href="/">Home</a></header><div id="cookie-notice">We use cookies <b>here</b></div>
<nav><ul><li><a href="a">One</a><li>Two</ul></nav><main><article><h1>Big
 &lt;News&gt;</h1><div class='share'>Share me</div><p>First <b>bold</b> and&nbsp;<a title="x > y" href=z>link</a>.<p>Second<br>line
<script>var x = "<p>no</p>";</script><aside>Side</aside><form><label>Mail</label><input></form>
<ul><li>a<li>b</ul><div class="ad-slot ad">Buy</div><!-- <p>gone</p> --><blockquote>said &#8220;so&#x201D;</blockquote>
<section class="comments"><p>First!</p></section></article></main><aside>More</aside><footer>&copy; us</footer></body></html>"""
WANTED = "Big <News>\nFirst bold and link.\nSecond line\na\nb\nsaid “so”"


def test_what_belongs_to_an_article():
    wrapper = pages.infer([pages.fold([s for s, _ in pages.read(RICH)])])
    assert pages.extract(RICH, wrapper) == WANTED
    assert pages.extract(RICH, None) == WANTED


def test_wrappers_are_expressions():
    shapes = ["<ul><li>a</li><li>b</li></ul><p>x</p>", "<ul><li>a</li></ul><div>d</div><p>x</p><p>y</p>", "<p>x</p>"]
    streams = [pages.fold([s for s, _ in pages.read(h)]) for h in shapes]
    wrapper = pages.infer(streams)
    assert wrapper.expression() == "(<ul>(<li>#ul/li</li>)+</ul>)?(<div>#div</div>)?(<p>#p</p>)+"
    assert all(map(wrapper.fits, streams))
    assert not wrapper.fits(pages.fold([s for s, _ in pages.read("<h1>t</h1>")]))
    assert pages.Wrapper.loads(wrapper.dumps()) == wrapper


def unfolded(nodes):
    return [x for n in nodes for x in (unfolded(n) if isinstance(n, list) else [n])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40))
def test_folding_keeps_order_and_ends(symbols):
    folded = pages.fold(symbols)
    assert set(unfolded(folded)) == set(symbols)
    expression = pages.Wrapper(folded, [1] * len(folded), 1).expression()
    assert re.fullmatch(expression, "".join(symbols))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=12), min_size=1, max_size=4))
def test_wrappers_describe_what_they_are_made_of(streams):
    wrapper = pages.infer([pages.fold(s) for s in streams])
    held = set(unfolded(wrapper.nodes))
    assert all(set(s) <= held for s in streams)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class=ad>", "</div>", "<", "x", "&amp;", '<a b="', "'", ">", "<!--", "-->",
                                 "<article>", "</article>", "<script>", "</script>", "<li>", " \n", "</", "<!x"]), max_size=25).map("".join))
def test_any_input_is_read(page):
    symbols = [s for s, _ in pages.read(page)]
    assert sum(s.startswith("<") and not s.startswith("</") for s in symbols) == sum(s.startswith("</") for s in symbols)
    assert isinstance(pages.extract(page, None), str)


@pytest.mark.parametrize("page", ["<p>" * 50_000, '<a b="' * 50_000, "<!--" * 100_000, "<article><p>x" + "<b>y" * 60_000, "<div>" * 3000 + "z", "<li>a" * 30_000])
def test_long_and_broken_pages(page):
    pages.extract(page, None)


def test_edges(spark):
    rows = [(1, "http://a.b/c", None), (2, None, ""), (3, "x", "plain words"), (4, "http://a.b/d", RICH), (None, "http://a.b/d", RICH),
            (4, "http://a.b/d", RICH), (5, "http://A.b", "<body><nav>menu</nav><div>left <i>over</i></div></body>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "host": F.lit(2), "wrapper": F.lit(3)})
    want = ["", "", "plain words", WANTED, WANTED, WANTED, "left over"]
    got = sorted((str(r.page_id), r.url or "", r.text, r.n_chars) for r in pages.page_texts(table).collect())
    assert got == sorted((str(i), u or "", t, len(t)) for (i, u, _), t in zip(rows, want))
    assert pages.page_texts(table.limit(0)).collect() == []


def body_page(i, extra=""):
    return f"<body><div><h2>Our shop</h2><p>Welcome</p></div>{extra}<div><h3>News {i}</h3><p>text {i}</p><p>more {i}</p></div></body>"


def test_texts_of_the_host_decide(spark):
    """Without an article, what is the same on most pages of a host is template; elsewhere it stays."""
    rows = [(i, "http://shop.x/a", body_page(i)) for i in range(4)]
    rows += [(4, "http://shop.x/b", body_page(4, "<table><tr><td>own</td></tr></table>")), (5, "http://other.x/", body_page(5))]
    rows += [(i, "http://same.x/", body_page(6)) for i in (6, 7, 8)]  # one page thrice shows nothing
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.page_texts(table).collect()}
    body = "News {0}\ntext {0}\nmore {0}"
    assert [got[i] for i in range(4)] == [body.format(i) for i in range(4)]
    assert got[4] == "own\n" + body.format(4)
    assert got[5] == "Our shop\nWelcome\n" + body.format(5)
    assert {got[i] for i in (6, 7, 8)} == {"Our shop\nWelcome\n" + body.format(6)}


def test_pages_outside_the_wrapper_are_aligned():
    wrapper = pages.infer([pages.fold([s for s, _ in pages.read(body_page(0))])])
    place = wrapper.nodes.index("#body/div/h2")
    wrapper.texts = {f"{place} #body/div/h2": [5, 4], f"{place + 3} #body/div/p": [5, 2]}
    assert not wrapper.fits(pages.fold([s for s, _ in pages.read(body_page(1, "<ul><li>new</li></ul>"))]))
    assert pages.extract(body_page(1, "<ul><li>new</li></ul>"), wrapper) == "Welcome\nnew\nNews 1\ntext 1\nmore 1"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=40))
def test_folding_counts_what_it_takes(symbols):
    folded, sizes = pages._folded(symbols)
    assert folded == pages.fold(symbols) and len(sizes) == len(folded) and sum(sizes) == len(symbols)
    at = 0
    for node, size in zip(folded, sizes):
        assert set(unfolded([node])) == set(symbols[at : at + size])
        at += size


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=12), st.lists(st.sampled_from("abc"), max_size=12))
def test_alignments_are_longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    pairs = pages._aligned(a, b)
    assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))


@pytest.mark.parametrize(
    "page",
    [
        "<body><article class='post has-sidebar'><p>kept</p></article></body>",
        "<body class='no-sidebar'><article><p>kept</p></article></body>",
        "<html class='ad'><body class='cookie-consent'><p>kept</p></body></html>",
        "<body><article><section id='social-history'><p>kept</p></section></article></body>",
        "<body><div class='content with-comments'><p>kept</p></div></body>",
        "<body><div class='widget'><article><p>kept</p></article></div></body>",
        "<body><div class='related'><article><p>kept</p></article></div><p>no</p></body>",
        "<body><main class='share'><p>kept</p></main></body>",
        "<body><article><p>kept</p></article><div class='related'><article><p>a teaser that is longer</p></article></div></body>",
        "<body><main><p>kept</p><div class='comments'><article>no</article></div></main></body>",
        "<body><article class='alert'><p>kept</p><div class='ad'>x</div><div class='notice'>y</div></article></body>",
    ],
)
def test_words_on_blocks_that_hold_the_article(page):
    assert pages.extract(page, None) == "kept"


def test_words_mark_what_the_host_shows(spark):
    """A listed word counts only where the block is the same on most pages, or names what always varies."""

    def page(i):
        return (f"<body><article><h1>t{i}</h1><div class='share-box'>Share this</div><div class='alert'>Storm {i}</div>"
                f"<section class='social-history'>In {i}</section><div class='notice'>Mind the gap</div>"
                f"<div class='comments'>{i} said</div></article><div class='widget'>other {i}</div></body>")  # fmt: skip

    table = spark.createDataFrame([(i, "http://a.b/", page(i)) for i in range(4)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.page_texts(table).collect()}
    assert got == {i: f"t{i}\nStorm {i}\nIn {i}" for i in range(4)}


def test_texts_are_compared_over_every_structure_of_a_host(spark):
    tags = ["div", "section", "blockquote", "figure", "details"]
    rows = []
    for i in range(20):  # more structures than a wrapper is inferred from
        extra = "".join(f"<{t}>t{i}</{t}>" for b, t in enumerate(tags) if i >> b & 1)
        rows.append((i, "http://h.example/p", f"<html><body><p>same</p>{extra}</body></html>"))
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    (one,) = pages.wrappers(table).collect()
    shown = pages.Wrapper.loads(one.wrapper).texts
    assert max(pages for pages, _ in shown.values()) == 20


@pytest.mark.parametrize("size", [None, 3])
def test_wrappers_describe_every_structure_of_a_host(spark, size):
    """However rare or long a structure is, and however the structures are dealt out."""
    tags = ["div", "section", "blockquote", "figure", "details"]
    htmls = ["<body>" + "".join(f"<{t}>t{i}</{t}>" for b, t in enumerate(tags) if i >> b & 1) + "</body>" for i in range(32)]
    long = random.Random(1).choices(["h1", "h2", "h3", "h4", "h5", "pre", "ul", "ol", "dl", "table"], k=3000)
    htmls.append("<body>" + "".join(f"<{t}>a</{t}>" for t in long) + "</body>")
    streams = [pages.fold([s for s, _ in pages.read(h)]) for h in htmls]
    assert len(streams[-1]) > 1500
    rows = [(i, "http://h.example/p", h) for i, h in enumerate(htmls)] + [(99, "http://one.example/", htmls[1])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.host: r for r in pages.wrappers(table, **({"size": size} if size else {})).collect()}
    assert sorted(got) == ["h.example", "one.example"]
    wrapper = pages.Wrapper.loads(got["h.example"].wrapper)
    assert all(set(unfolded(s)) <= set(unfolded(wrapper.nodes)) for s in streams)
    assert all(-1 not in wrapper.match(s, [1] * len(s)) for s in streams)
    assert got["one.example"].expression == "<body><div>#body/div</div></body>"


def test_rare_structures_are_compared(spark):
    """A slot that only rare structures have is template where they all show the same."""
    rare = ["div", "section", "blockquote"]
    rows = []
    for i in range(20):  # more frequent structures than a wrapper was once inferred from
        extra = "".join(f"<{t}>x</{t}>" for b, t in enumerate(["ul", "ol", "dl", "pre", "figure"]) if i >> b & 1)
        rows += [(100 * i + k, "http://h.example/p", f"<body><p>text {i} {k}</p>{extra}</body>") for k in range(3)]
    rows += [(9000 + k, "http://h.example/q", f"<body><p>text {k}</p><table><tr><td>Terms</td></tr></table><{t}>own {k}</{t}></body>") for k, t in enumerate(rare)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.page_texts(table).collect()}
    assert [got[9000 + k] for k in range(3)] == [f"text {k}\nown {k}" for k in range(3)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcd"), min_size=1, max_size=12), min_size=1, max_size=12))
def test_united_wrappers(streams):
    folded = [pages.fold(s) for s in streams]
    one = pages.united([pages.infer(folded[i : i + 3]) for i in range(0, len(folded), 3)])
    assert all(set(s) <= set(unfolded(one.nodes)) for s in streams)
    flat = pages.infer(folded)
    written = flat.expression()
    flat.shorten()
    assert flat.expression() == written and pages.Wrapper.loads(flat.dumps()) == flat
