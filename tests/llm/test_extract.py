import html
import itertools
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm.dom import name_tokens, parse
from quern.llm.extract import IN, MIXED, NEVER, OUT, Forest, Model, extract_main, fit, main_texts, states_of
from quern.llm.layouts import labelled_pages
from quern.llm.queries import QUERIES

MODEL = fit(labelled_pages())


def text_of(page):
    return main_texts(MODEL, [parse(page)])[0]


def tree(page):
    """Nested lists of tags and texts."""
    nodes = parse(page)
    made = [[n.tag] if n.tag is not None else n.text for n in nodes]
    for n, m in zip(nodes[1:], made[1:]):
        made[n.parent].append(m)
    return made[0][1:]


def test_markup():
    assert tree("<p>a<p>b<b>c</b><br>d") == [["p", "a"], ["p", "bc d"]]
    assert tree("<ul><li>a<li>b<ul><li>c</ul>d</ul>e") == [["ul", ["li", "a"], ["li", "b", ["ul", ["li", "c"]], "d"]], "e"]
    assert tree("<div>a<p>b</div>c</x>d</p>e") == [["div", "a", ["p", "b"]], "cd", "e"]
    assert tree("<script>var t='<p>x</p>';</script >a<style>b</style><!-- <p>c --><!-->d<?php x?>e<!doctype q>") == ["ade"]
    assert tree("a < b &lt;p&gt; &amp;amp; &copy &#x41;&nbsp;&#32; z<") == ["a < b <p> &amp; © A z<"]
    assert tree("<p title='>'>a<p title=\"x>y\" b>c") == [["p", "a"], ["p", "c"]]
    assert tree("a<script>b") == ["a"] and tree("a<!-- b") == ["a"] and tree("a<p class='x") == ["a"] and tree("<script/>a") == ["a"]
    assert tree("<table><tr><td>a<td>b<tr><th>c</table>") == [["table", ["tr", "a b"], ["tr", "c"]]]
    assert tree("<html><head><title>t</title><body>x") == ["x"] and tree("") == [] and tree(" \n\t ") == []
    assert name_tokens(' class="siteFooter ad-slots x" id=comments hidden') == {"site", "footer", "ad", "slot", "comment", "hidden"}
    assert name_tokens(" data-class=no") == set() and name_tokens(' style="display: none"') == {"hidden"}


def test_long_and_deep_pages_take_linear_time():
    deep = "<div>" * 30_000 + "x"
    nodes = parse(deep)
    assert nodes[-1].depth == 30_001 and main_texts(MODEL, [nodes]) in (["x"], [""])
    assert len(parse("<a \"" * 200_000)) == 1 and len(parse("<li>a" * 50_000)) == 100_001 and len(parse("</div>" * 300_000)) == 1
    assert parse("x" * 5_000_000)[1].size == 5_000_000


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"<>/ab!-'\"= \n&;#é", "div", "p", "<p>", "</div>", "<div>", "<li>", "<script>"]), max_size=60))
def test_any_text_is_taken(pieces):
    page = "".join(pieces)
    nodes = parse(page)
    assert all(n.parent < i for i, n in enumerate(nodes)) and all(n.depth == nodes[n.parent].depth + 1 for n in nodes[1:])
    assert isinstance(text_of(page), str)


def by_enumeration(nodes, model, shown):
    """Marginals by adding up all assignments of states."""
    total = np.zeros((len(nodes), 3))
    for states in itertools.product(range(3), repeat=len(nodes)):
        if states[0] != MIXED or any(n.tag is None and s == MIXED for n, s in zip(nodes, states)):
            continue
        score = sum(shown[i][s] for i, s in enumerate(states))
        score += sum(model.ties[int(n.tag is None), states[n.parent], s] for n, s in zip(nodes[1:], states[1:]))
        for i, s in enumerate(states):
            total[i, s] += np.exp(score)
    return total / total.sum(axis=1, keepdims=True)


def test_messages_give_exact_marginals():
    pages = ["<div>a<p>b</p>c</div>d", "<ul><li>a<li>b</ul>", "x", "", "<div><div><div>y</div></div></div>"]
    rnd = np.random.default_rng(3)
    model = Model({}, np.zeros((0, 3)), rnd.normal(size=(2, 3, 3)))
    trees = [parse(p) for p in pages]
    shown = [rnd.normal(size=(len(t), 3)) for t in trees]
    got, pairs = Forest(trees).marginals(model, np.concatenate(shown), pairs=True)
    want = np.concatenate([by_enumeration(t, model, s) for t, s in zip(trees, shown)])
    assert np.allclose(got, want)
    assert np.isclose(pairs.sum(), sum(len(t) - 1 for t in trees)) and NEVER < -1e6


def test_held_out_labelled_pages():
    """Pages that the fit has not seen: nearly all blocks right, and nearly all pages in whole."""
    right = blocks = whole = 0
    pages = list(labelled_pages(200, seed=99))
    for page in pages:
        nodes = parse(page)
        states = states_of(nodes)
        want = [n.text for n, s in zip(nodes, states) if n.tag is None and s == IN]
        clean = parse(re.sub(" data-(?:main|other)", "", page))
        shown = np.array([MODEL.shown(n, clean[0].size) for n in clean])
        inside = Forest([clean]).marginals(MODEL, shown)[:, IN] > 0.5
        marks = [(s == IN) == k for n, s, k in zip(nodes, states, inside) if n.tag is None]
        right, blocks = right + sum(marks), blocks + len(marks)
        whole += main_texts(MODEL, [clean])[0] == "\n\n".join(want)
    assert right / blocks > 0.98 and whole / len(pages) > 0.9


def test_layouts_of_other_make():
    assert text_of(
        """<!doctype html><html><head><title>x</title></head><body class="home page"><div id="cookie-consent" class="consent-banner">
        <p>We use cookies to improve your experience.</p><button>OK</button></div><div id="header"><div class="logo"><a href="/">Site</a>
        </div><ul class="main-nav"><li><a href=a>Home</a><li><a href=b>News</a></ul></div><div id="wrapper"><div id="content">
        <div class="post"><h1>A title</h1><div class="entry"><p>First paragraph\n of text, with <b>bold</b> words.<p>Short.<p>Third &amp;
        more&nbsp;text.<div class="ad-box">Buy now! Great offers today.</div><ul><li>One point<li>Another point</ul><p>Last.</div></div>
        <div id="comments"><h3>2 Comments</h3><div class="comment"><span>Bob</span><p>Nice article, I liked it very much.</p></div></div>
        </div><div id="sidebar"><h3>About</h3><p>A blog about many things that we like.</p></div></div><div id="footer"><p>&copy; 2020
        Site.</p></div></body></html>"""
    ) == "A title\n\nFirst paragraph of text, with bold words.\n\nShort.\n\nThird & more text.\n\nOne point\n\nAnother point\n\nLast."
    assert text_of(
        "<body><header><nav><a href=1>Home</a> <a href=2>Two</a></nav></header><main><article><h1>T</h1><p>Para one.</p><p>Para two is longer "
        "than the first one, clearly so.</p><form><label>Email</label><input><button>Go</button></form><p>End of it.</p></article>"
        '<section id="comments"><p>Reader says hello there.</p></section></main><aside><p>Side words here.</p></aside><footer>Foot</footer>'
    ) == "T\n\nPara one.\n\nPara two is longer than the first one, clearly so.\n\nEnd of it."
    assert text_of("<h1>Bare</h1><p>Only paragraphs on this page.<p>And another one.") == "Bare\n\nOnly paragraphs on this page.\n\nAnd another one."
    assert text_of(
        '<table><tr><td class="menu"><a href=a>A</a></td></tr></table><div class=content><h1>Old</h1><p>Old style text.</p>More text directly.</div>'
    ) == "Old\n\nOld style text.\n\nMore text directly."


def articles(page):
    """The article of a page of the given make: its blocks end at h1 and p tags."""
    inner = re.search("<article>(.*)</article>", page, re.S)[1]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
    return "\n\n".join(b for b in blocks if b)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: (r.url, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op12_main_text"](spark, sf).collect()
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in rows} == {
        i: (url, articles(page), len(articles(page))) for i, (url, page) in pages.items()
    }


def test_awkward_rows(spark):
    page = "<article><h1>T</h1><p>One \U0001d4b3 here.</p></article><footer>&copy; x</footer>"
    rows = [(1, None), (2, ""), (3, page), (3, page), (None, page), (4, "<nav><a href=x>Menu</a></nav>"), (5, f"<article>{'<p>Some text.</p>' * 30_000}</article>")]
    df = spark.createDataFrame(rows, "page_id bigint, html string").selectExpr("*", "1 AS TEXT", "'u' AS url")
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in extract_main(df).collect())
    said = "T\n\nOne \U0001d4b3 here."
    long = "\n\n".join(["Some text."] * 30_000)
    assert got == sorted([("1", "", 0), ("2", "", 0), *[("3", said, 14)] * 2, ("None", said, 14), ("4", "", 0), ("5", long, len(long))])
    assert extract_main(df.limit(0)).count() == 0 and OUT == 0
