from helpers import column, meta


def values(spark, name, cases):
    got = column(meta(spark, *[html for html, _ in cases]), name)
    assert got == [want for _, want in cases]


def test_title(spark):
    og = '<meta property="og:title" content="T">'
    values(spark, "title", [
        ("<h1>Hello <b>World</b></h1>", "HelloWorld"),
        (og + "<h1></h1>", ""),
        (og, "T"),
        ("<p>x</p>", ""),
        ('<meta property="og:title">', ""),
        ("<h1>a<script>b</script><!-- c --> d</h1><h1>e</h1>", "ad"),
        ("", ""),
    ])


def test_author_and_image(spark):
    byl, author = '<meta name="byl" content="B">', '<meta name="author" content="A">'
    values(spark, "author", [
        (author + byl, "B"),
        (author, "A"),
        ('<meta name="byl">' + author, None),
        ('<meta name="author" content="">', ""),
        ("", None),
    ])
    values(spark, "image", [
        ('<meta property="og:image" content="i.jpg"><meta property="og:image" content="j">', "i.jpg"),
        ('<meta name="og:image" content="i.jpg">', None),
    ])


def test_tags(spark):
    values(spark, "tags", [
        ('<meta name="keywords" content=" A, ,b,A ">', "a, b, a"),
        ('<meta name="news_keywords" content=""><meta name="keywords" content="x">', None),
        ('<meta name="keywords" content="x"><meta name="news_keywords" content="y">', "y"),
        ('<meta name="news_keywords"><meta name="keywords" content="x">', None),
        ("", None),
    ])


def test_date_source(spark):
    def published(value):
        return f'<meta property="article:published_time" content="{value}">'

    values(spark, "published_date", [
        (published("") + '<time datetime="2025-12-01">', "2025-12-01T00:00:00"),
        ('<time>a</time><time datetime="2025-12-01">', None),
        (published("2025-12-02") + '<meta name="OriginalPublicationDate" content="2025-12-01">', "2025-12-02T00:00:00"),
        (published("") + published("2025-12-02"), None),
        (published("soon") + '<time datetime="2025-12-01">', None),
    ])


def test_canonical_address(spark):
    def link(rel, href):
        return f'<link rel="{rel}" href="{href}">'

    df = meta(
        spark,
        link("alternate canonical", "/c/"),
        link("canonical", ""),
        '<link rel="canonical">',
        link("canonical", "/"),
        link("canonicals", "/c"),
        link("canonical", "http://[broken/"),
        link("canonical", "https://Y.com/a?utm_source=b"),
        "",
        urls=["http://X.com/r/?utm_source=1"] * 7 + ["http://[broken/"],
    )
    own = "http://x.com/r"
    assert column(df, "url") == ["/c", own, own, own, own, None, "https://y.com/a", None]
    assert column(df, "norm_url") == [own] * 7 + [None]


def test_links_and_scripts(spark):
    df = meta(
        spark,
        '<link rel="amphtml" href="/amp"><script type="application/ld+json"></script>text'
        '<script type="application/ld+json">{"a":1}</script><script>x</script>',
        '<link rel="amphtml" href="">',
    )
    assert column(df, "amp_href") == ["/amp", None]
    assert column(df, "ld_json") == [[None, '{"a":1}'], []]
