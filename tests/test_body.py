import json
import re

import pytest
from helpers import column, meta, pages

from newsloom import amp_body, article_body, clean_paragraphs, extract_articles, jsonld_body, main_content
from newsloom.operators.amp import with_amp_body
from newsloom.operators.body import page_body
from newsloom.operators.dom import dom_nodes
from newsloom.operators.metadata import with_metadata
from newsloom.plans.articles import page_articles


def cleaned(spark, policy, *htmls):
    return column(clean_paragraphs(dom_nodes(pages(spark, *htmls)), policy), "paragraph_text")


def test_clean_join(spark):
    def wrap(inner):
        return f"<article>{inner}</article>"

    assert cleaned(
        spark,
        "four",
        wrap("<p>ab</p><p>abc</p>"),
        wrap('<p class="Shareholder">long text</p>'),
        *[wrap(f"<{t}><p>long text</p></{t}>") for t in ("aside", "figure", "nav", "footer", "header", "figcaption")],
        wrap('<div class="x-related"><p>long text</p></div>'),
        wrap("<p>one one</p><p>two two</p>"),
        wrap("<p>a <b> b </b> c</p>"),
        wrap("<p><b>xxx<br><p>yyy"),
        wrap("<p>and&amp</p>"),
        wrap("<p>a<script>no</script><ruby>b<rt>no</rt></ruby></p>"),
    ) == ["abc", "", "", "", "", "", "", "", "", "one one\n\ntwo two", "a b c", "xxx\n\nyyy", "and&", "a b"]


def test_selector_policies(spark):
    both = '<div data-component="text-block"><p>block</p></div><article><p>article</p></article>'
    htmls = (
        both,
        "<main><p>main</p></main><p>bare</p>",
        '<div class="a RichTextComponentWrapper-b"><p>rich</p></div><p>bare</p>',
        "<p>bare</p>",
        "<article><p>ab</p></article><main><p>main</p></main>",
    )
    assert cleaned(spark, "four", *htmls) == ["block", "main", "rich", "", ""]
    assert cleaned(spark, "three", *htmls) == ["article", "main", "rich\n\nbare", "bare", ""]


def script(value):
    text = value if isinstance(value, str) else json.dumps(value)
    return f'<script type="application/ld+json">{text}</script>'


def article(body, kind="NewsArticle"):
    return {"@type": kind, "articleBody": body}


def test_jsonld(spark):
    got = column(
        jsonld_body(
            meta(
                spark,
                script(article("one")),
                script([article("x", "Article"), article("longer"), article("mid")]),
                script(article("one", ["NewsArticle"])) + script({"@graph": [article("one")]}),
                script(article(12345)),
                script("{broken") + script(article(" padded ")),
                script(article("a" * 800)) + script(article("b" * 900)),
                script(article("a" * 799)) + script(article("b" * 900)),
                script([article("a" * 800), article("b" * 900)]),
                script(article("same")) + script(article("emas")),
                *[script(json.dumps(article("bad")) + rest) for rest in (";", "]", "}", ',{"a":1}', " x", "//c")],
                script("[1, \"x\", null]") + script("null") + script("") + script(article("ok")),
            )
        ),
        "jsonld_text",
    )
    assert got == ["one", "longer", "", "", "padded", "a" * 800, "b" * 900, "b" * 900, "same", *[""] * 6, "ok"]


def bodies(spark, *htmls, urls=None, content_policy="selectors", **options):
    landed = pages(spark, *htmls, urls=urls)
    df = article_body(meta(spark, *htmls, urls=urls), landed, content_policy, **options)
    return column(df, "body")


def test_cascade_thresholds(spark):
    def page(own, ld):
        return f"<article><p>{'a' * own}</p></article>" + script(article("b" * ld))

    got = bodies(spark, page(799, 900), page(800, 900), page(500, 500), page(500, 501))
    assert got == ["b" * 900, "a" * 800, "a" * 500, "b" * 501]


def test_amp(spark):
    def page(href, own="short text"):
        return f'<link rel="amphtml" href="{href}"><article><p>{own}</p></article>'

    htmls = (
        page("http://amp/a"),
        page("http://amp/none"),
        page("http://amp/a?utm_source=x"),
        page("http://amp/a", "s" * 900),
        "<p>amp twin, with a longer text</p>",
    )
    urls = ["http://x/0", "http://x/1", "http://x/2", "http://x/3", "http://amp/a"]
    assert bodies(spark, *htmls, urls=urls) == [
        "amp twin, with a longer text", "short text", "short text", "s" * 900, "",
    ]
    alone = amp_body(meta(spark, *htmls, urls=urls), pages(spark, *htmls, urls=urls))
    assert column(alone, "amp_text")[:3] == ["amp twin, with a longer text", "", ""]


def test_amp_with_one_hot_address(spark):
    html = '<link rel="amphtml" href="http://amp/a"><article><p>short</p></article>'
    landed = pages(spark, *[html] * 30, "<main><p>the amp twin</p></main>",
                   urls=[f"http://x/{i}" for i in range(30)] + ["http://amp/a"])
    own = page_body(with_metadata(dom_nodes(landed)), "selectors", out="content")
    got = column(with_amp_body(own, landed, "content", hot_rows=4), "content")
    assert got == ["the amp twin"] * 31


def test_main_content(spark):
    text = "A sentence, with a comma, that is long enough to count as a paragraph. " * 3
    html = (
        "<body><nav><ul><li><a href=x>Link one</a></ul></nav>"
        f'<div class="sidebar"><p>{text}</p></div>'
        f'<div id="story"><h2>Head</h2><p>{text}</p><p>{text}</p><aside><p>{text}</p></aside></div>'
        f'<div class="comments"><p>{text}</p><p>{text}</p></div>'
        "<footer><p>Copyright and all other rights reserved</p></footer>"
    )
    links = f"<div>{'<p><a>' + text + '</a></p>'}</div><section><p>{text}</p></section>"
    got = column(main_content(dom_nodes(pages(spark, html, links, "", "<p>short</p>", f"<p>{text}</p>"))), "main_text")
    body = text.strip()
    # Without a scored paragraph the whole body counts.
    assert got == [f"Head {body} {body}", body, "", "short", body]


def test_main_content_comes_first_in_the_full_policy(spark):
    long = "Words, and more words that make up a text. " * 30
    html = f"<div><p>{long}</p></div><article><p>other</p></article>"
    assert bodies(spark, html, content_policy="full") == [long.strip()]
    assert bodies(spark, html) == ["other"]


def test_thin_pages_and_reject_reasons(spark):
    def page(n, head=""):
        return f"{head}<article><p>{'é' * n}</p></article>"

    htmls = [page(199), page(200), page(500), page(500, '<link rel="canonical" href="http://[x/">')]
    landed = pages(spark, *htmls, urls=["http://x/0", "http://x/1", "http://[x/2", "http://x/3"])
    rows = page_articles(landed, content_policy="selectors")
    assert column(rows, "reject_reason") == ["thin", None, "bad_link", "bad_canonical"]
    assert column(extract_articles(landed, content_policy="selectors"), "entry_ord", "entry_ord") == [1]


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        bodies(spark, "<p>x</p>", content_policy="best")


def test_main_content_without_paragraphs(spark):
    htmls = [
        "<head><title>t</title></head><body><nav>menu</nav><div>One line<br>and another one, long enough</div></body>",
        "<div><div>nested text</div><div>more of it</div></div>",
        "<body><ul><li>first item<li>second item</ul><script>no()</script></body>",
    ]
    got = column(main_content(dom_nodes(pages(spark, *htmls))), "main_text")
    assert got == ["One line and another one, long enough", "nested text more of it", "first item second item"]


def test_failed_loads_give_no_article_and_no_twin(spark):
    from newsloom import extract_articles

    text = "A sentence that is long enough to be kept by every rule there is. " * 5
    rows = [
        (1, "http://x/1", f"<article><h1>a</h1><p>{text}</p></article>", 404),
        (2, "http://x/2", f"<link rel=amphtml href='http://x/amp'><article><h1>b</h1><p>{text}</p></article>", None),
        (3, "http://x/amp", f"<main><p>{text * 2}</p></main>", 500),
    ]
    landed = spark.createDataFrame(rows, "page_id bigint, url string, html string, status int")
    got = extract_articles(landed, content_policy="selectors").collect()
    assert [(r.entry_ord, len(r.content)) for r in got] == [(2, len(text.strip()))]


def test_the_session_is_left_as_it_is(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    dom_nodes(pages(spark, "<p>x")).collect()
    assert spark.conf.get(key) == before


def test_an_article_in_several_containers_comes_whole(spark):
    words = "Some words, and more of them, to fill a line of the article that is long enough. "

    def p(n, times=1):
        return f"<p>{n} {words * times}</p>"

    big = f"<section>{p('a', 3)}{p('b', 3)}{p('c', 3)}{p('d', 3)}</section>"
    got = column(
        main_content(
            dom_nodes(
                pages(
                    spark,
                    # Neighbours with a fifth of the score belong to it, bare paragraphs beside it, too.
                    f"<div>{big}<h2>x</h2><section>{p('e', 2)}</section>{p('f')}<p>g</p></div>",
                    # Link lists, listed names, furniture and other branches don't.
                    f"<div>{big}<section><p>e <a>{words}</a></p></section><div class='comments'>{p('f')}</div>"
                    f"<aside>{p('g')}</aside><p><a>{words}</a></p></div><div><section>{p('h')}</section></div>",
                )
            )
        ),
        "main_text",
    )
    first = [t[0] for t in re.findall(r"\b([a-z]) Some", got[0])]
    assert first == list("abcdef") and not got[0].endswith(" g")
    assert re.findall(r"\b([a-z]) Some", got[1]) == list("abcd")


def test_jsonld_with_a_repeated_key(spark):
    def one(text):
        return f'<script type="application/ld+json">{text}</script>'

    got = column(
        jsonld_body(
            meta(
                spark,
                one('{"@type":"Article","articleBody":"a","articleBody":"bb","author":{"x":1,"x":2}}'),
                one('[{"@type":"WebPage","articleBody":"no"},{"@type":"WebPage","@type":"Article","articleBody":"ccc"}]'),
                one('{"@type":"Article","articleBody":"a","articleBody":5}'),
                one('{"@type":"Article","articleBody":"a","articleBody":"b"} tail'),
                one('{"@type":"Article","articleBody":"a","articleBody":"b"'),
                one('{"@type":"Article","articleBody":"a","articleBody":"b"},{"#end":true}'),
            )
        ),
        "jsonld_text",
    )
    assert got == ["bb", "ccc", "", "", "", ""]
