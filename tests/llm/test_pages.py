"""Main text of pages: template parts, broken markup and sites."""

import math
import random
import time
from collections import Counter, defaultdict

import pytest

from newsloom.llm import site_style
from newsloom.llm.page_blocks import blocks_of
from newsloom.llm.site_style import extract_text, importance, parsed_pages


def text(html):
    return "\n".join(b.text for b in blocks_of(html)[0])


def test_furniture_goes():
    html = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="no-sidebar">
    <header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div><nav><ul><li><a href="/">Home</a></ul></nav>
    <main><article class="post"><header class="entry-header"><h1>Head &amp; tail</h1></header>
    <p>One<br>two   &lt;b&gt; caf&eacute;&nbsp;x<p>Three <a href="x>y">link</a> f<b>o</b>ur<ul><li>i1<li>i2</ul>
    <div class="ad-slot">buy</div><form><input>search <button>go</button></form><aside>rel</aside>loose text
    <table><tr><td>a<td>b<tr><td>c</table><!-- <p>no</p> --><script>var a="</p><p>no";</script>
    <section id="comments"><article class="comment"><p>nice</p></article></section></article></main>
    <div class="Sidebar">side</div><footer>f</footer></body></html>"""
    assert text(html) == "Head & tail\nOne two <b> café x\nThree link four\ni1\ni2\nloose text\na\nb\nc"


def test_without_article():
    assert text("<body><div>First<div>second</div>third</div><ul><li><a href=x>menu</a></ul></body>") == "First\nsecond\nthird"
    assert text("<main><p>m</p></main><p>outside of the main part") == "m\noutside of the main part"
    assert text("<main><p>main part, long enough</p></main><p>outside") == "main part, long enough"
    assert text("plain &amp; simple") == "plain & simple"
    assert text("<p hidden>x<p style='display: none'>y<p aria-hidden=true>z<p>seen") == "seen"


def test_broken_markup():
    assert text("<p>a<p>b</div>c</b>") == "a\nbc"
    assert text("<p title=it's>hello") == "hello" and text('<p class="x>hello') == "hello"
    assert text('<p class="a>b">c') == "c" and text("<p a=1 a=2 b>x</p >y<p") == "x\ny"
    assert text("<p>a <script>never closed <p>b") == "a"
    assert text("<article><p><b>x.<br><p>y</p></article>") == "x.\ny"
    assert text("a < b and <3 c") == "a < b and <3 c"
    assert text("<" * 20_000) == "<" * 20_000
    assert len(text("<div>" * 5_000 + "deep")) == 4
    assert text("<p>" + "long " * 200_000).count("long") == 200_000


WORDS = "some words that go on for a while so that this is a paragraph of prose"


@pytest.mark.parametrize(
    "html, want",
    [
        (f'<div class="content has-sidebar"><article><p>{WORDS}</article></div>', [WORDS]),
        (f'<div id="page" class="no-sidebar"><p>{WORDS}</div>', [WORDS]),
        (f'<form id="page" class="menu"><article><p>{WORDS}</article></form>', [WORDS]),
        (f'<article><p>{WORDS}<section id="related-work"><p>A {WORDS}</section></article>', [WORDS, f"A {WORDS}"]),
        (f'<article><p>{WORDS}<div class="search-results"><p>A {WORDS}</div></article>', [WORDS, f"A {WORDS}"]),
        (f'<article><p>{WORDS}<p class="share-price">up by 5 %</article>', [WORDS, "up by 5 %"]),
        (f'<article><p>{WORDS}<div class="legal-notice-explained">A {WORDS}</div></article>', [WORDS, f"A {WORDS}"]),
        (f"<h1>Title</h1><article><p>{WORDS}</article>", ["Title", WORDS]),
        (f"<header><h1>Site</h1></header><article><p>{WORDS}</article>", [WORDS]),
        (f"<p><a href=x>{WORDS}</a><ul><li><a href=y>Home page of it all</a></ul><p>own", [WORDS, "own"]),
        (f'<article><p>{WORDS}<div class="related-links"><a>{WORDS}</a></div></article>', [WORDS]),
        (f'<article><p>{WORDS}</article><div id="reader-comments"><article class="comment"><p>{WORDS}</article></div>', [WORDS]),
        (f'<article><p>{WORDS}<div class="newsletter-signup"><p>{WORDS}</div><div class="share-bar">x</div></article>', [WORDS]),
    ],
)
def test_names_are_evidence_and_articles_stay(html, want):
    assert text(html).split("\n") == want


@pytest.mark.parametrize(
    "part", ["<script ", '<a "x" ', "<", "<div>", "<b><p>", "<li><b>", "<!--", "<a b='", "<div class=ad>", "<b>x", "<tr>", "</p>", "<i></x>"]
)
def test_hostile_pages_take_time_in_proportion(part):
    def seconds(size):
        html = part * (size // len(part))
        start = time.process_time()
        blocks_of(html)
        return time.process_time() - start

    # A megabyte takes about a second here; ten times that would be no proportion.
    assert seconds(1_000_000) < 10


def test_the_style_tree_equals_a_plain_one(spark):
    r = random.Random(4)
    rows = []
    for i in range(60):
        menu = "".join(f"<li>{w}</li>" for w in ("Home", "News", "About")[: r.choice([3, 3, 3, 2])])
        side = f"<div class=x><p>{r.choice(['Weather', 'Sports'])}</p></div>" * r.choice([1, 1, 2])
        own = "".join(f"<p>{r.random()}</p>" for _ in range(r.randrange(4)))
        rows.append((i, f"http://{'ab'[i % 2]}.com/{i}", f"<ul>{menu}</ul>{side}<section>{own}</section>"))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    parsed = parsed_pages(pages.selectExpr("page_id", "substring(url, 8, 1) AS host", "html")).cache()
    leaves, branches = importance(parsed, "host")
    got_leaves = {(x.host, x.node, x.feature): x.importance for x in leaves.collect()}
    got_branches = {(x.host, x.node): (x.pages, x.importance) for x in branches.collect()}
    texts, nodes, styles, within, paths = Counter(), Counter(), defaultdict(Counter), Counter(), {}
    for i, url, html in rows:
        host, (blocks, seen) = url[7], blocks_of(html)
        for key in {(host, b.node, b.parent, b.feature) for b in blocks}:
            texts[key] += 1
        for node in {b.node for b in blocks}:
            nodes[host, node] += 1
        for node in {n for b in blocks for n in (b.node, *b.branches)}:
            within[host, node] += 1
        for node, style in seen:
            styles[host, node][style] += 1
        paths.update({(host, b.node): b.branches for b in blocks})

    def presentation(key):
        m = sum(styles[key].values())
        return -sum(n / m * math.log(n / m, m) for n in styles[key].values()) if m > 1 else 1.0

    share = site_style.CONTENT_SHARE
    want_leaves, sums = {}, defaultdict(lambda: [0.0, 0])
    for (host, node, parent, feature), n in texts.items():
        pages_with = nodes[host, node]
        content = 1 - math.log(n) / math.log(pages_with) if pages_with > 1 else 1.0
        value = share * content + (1 - share) * presentation((host, parent))
        want_leaves[host, node, feature] = value
        for at in (node, *paths[host, node]):
            sums[host, at][0] += n * value
            sums[host, at][1] += n
    assert got_leaves == pytest.approx(want_leaves)
    assert set(got_branches) == set(sums)
    for key, (total, n) in sums.items():
        assert got_branches[key][0] == within[key]
        assert got_branches[key][1] == pytest.approx(share * total / n + (1 - share) * presentation(key))


def test_branches_go_with_changing_text(spark):
    rows = []
    for i in range(30):
        menu = "".join(f"<li>item {k}" for k in range(14)) + f"<li>you are here {i}"
        rows.append((i, f"http://a.com/{i}", f"<div><ul class=top>{menu}</ul><div class=story><p>story {i}<p>more {i}</div></div>"))
    got = extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == {i: f"story {i}\nmore {i}" for i in range(30)}


def test_sites(spark):
    rows = []
    for i in range(12):
        rows.append((i, f"http://a.com/{i}", f"<article><p>Read more stories like this</p><p>story {i}</p></article>", "own"))
    rows += [(20 + i, f"http://b.com/{i}", "<article><p>same</p><p>copy</p></article>", "own") for i in range(12)]
    rows += [(40, "http://c.com/", "<article><p>Read more stories like this</p><p>c</p></article>", "own")]
    rows += [(50, None, "<p>no address", "own"), (51, "http://a.com/x", None, "own"), (52, "http://a.com/y", "", "own")]
    rows += [(None, "http://a.com/z", "<p>no id", "own"), (0, rows[0][1], rows[0][2], "own")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = extract_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = {}
    for r in got.collect():
        found[r.page_id] = r.text
        assert r.n_chars == len(r.text)
    assert all(found[i] == f"story {i}" for i in range(12))
    assert all(found[20 + i] == "same\ncopy" for i in range(12))
    assert found[40] == "Read more stories like this\nc"
    assert (found[50], found[51], found[52], found[None]) == ("no address", "", "", "no id")
    assert got.count() == len(rows)
    assert extract_text(pages.limit(0)).count() == 0
