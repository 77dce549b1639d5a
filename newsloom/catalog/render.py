"""Feeds, pages and article rows derived from the ``documents`` table.

The given pages carry no metadata, JSON-LD or AMP links, so the registered
queries render such pages out of ``documents``, one variant per residue of
``doc_id``, and extract them again; the expected values are then plain
expressions over ``documents``.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import article_id, content_hash
from newsloom.sources.pages import spread

# Feeds are runs of this many neighbouring documents, so a feed document is
# bounded whatever the size of the table.
FEED_RUN = 100
# Added to a feed's number for a feed without a document.
NOT_LANDED = 500_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def escaped(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def doc_text() -> Column:
    return F.col("doc_id").cast("string")


def case(by: int, *variants: Column | str) -> Column:
    """The variant numbered ``doc_id % by``; literal text or an expression."""
    out = F.lit(None).cast("string")
    for i, v in enumerate(variants):
        value = F.lit(v) if isinstance(v, str) else v
        out = F.when(F.col("doc_id") % by == i, value).otherwise(out)
    return out


def request_url() -> Column:
    return F.concat(
        F.lit("HTTPS://WWW.News.example.com/"), F.col("lang"), F.lit("/"), doc_text(),
        F.lit("/?utm_source=rss&id="), doc_text(), F.lit("#top"),
    )


def paragraphs_html() -> Column:
    """Every line of the text as a paragraph, left unclosed now and then."""
    lines = F.transform(
        F.split("text", "\n"), lambda x: F.concat(F.lit("<p>"), escaped(x))
    )
    return F.call_function("array_join", lines, case(2, "</p>", "<br>"))


def furniture_html() -> Column:
    return F.concat(
        F.lit('<p class="Shareholder">'), escaped(F.col("source")), F.lit(" share this</p>"),
        F.lit("<aside><p>"), F.col("lang"), F.lit(" see also</p></aside>"),
        F.lit('<div class="x-related"><p>more of '), F.col("lang"), F.lit("</p></div><p>ab</p>"),
    )


def canonical_html() -> Column:
    return case(
        4,
        F.concat(
            F.lit('<link rel="alternate canonical" href="HTTPS://Canon.example.org/'),
            F.col("source"), F.lit("/"), doc_text(), F.lit('/">'),
        ),
        "",
        '<link rel="canonical" href="/">',
        F.concat(
            F.lit("<link rel=canonical href='/"), F.col("source"), F.lit("/"), doc_text(),
            F.lit("/?at_medium=x'>"),
        ),
    )


def title_html() -> Column:
    og = F.concat(
        F.lit('<meta property="og:title" content="'),
        escaped(F.col("text")), F.lit('">'),
    )
    return case(
        3,
        F.concat(F.lit("<h1> Title <b> "), doc_text(), F.lit("</b> &amp;<script>no()</script></h1>")),
        og,
        F.concat(og, F.lit("<h1></h1>")),
    )


def author_html() -> Column:
    byl = F.concat(F.lit('<META NAME="byl" content="'), escaped(F.col("source")), F.lit('">'))
    plain = F.concat(F.lit('<meta name="author" content="'), F.col("lang"), F.lit('"/>'))
    return case(
        5, F.concat(plain, byl), plain, F.concat(F.lit('<meta name="byl">'), plain),
        '<meta name="author" content="">', "",
    )


def image_html() -> Column:
    return case(
        2,
        F.concat(
            F.lit('<meta property="og:image" content="https://img.example.com/'), doc_text(),
            F.lit('.jpg?a=1&amp;b=2">'),
        ),
        "",
    )


def tags_html() -> Column:
    def keywords(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'<meta name="{name}" content="'), value, F.lit('">'))

    listed = F.concat(
        F.lit(" "), F.upper("lang"), F.lit(", ,"), F.col("source"), F.lit(","), F.upper("lang"),
        F.lit(" "),
    )
    return case(
        5,
        keywords("keywords", listed),
        F.concat(keywords("news_keywords", F.lit("")), keywords("keywords", listed)),
        F.concat(keywords("keywords", F.lit("x")), keywords("news_keywords", F.lit("A,B c"))),
        "",
        keywords("keywords", escaped(F.col("text"))),
    )


def date_html() -> Column:
    def number(modulus: int, base: int) -> Column:
        return F.lpad((F.col("doc_id") % modulus + base).cast("string"), 2, "0")

    ymd = F.concat(F.lit("2025-"), number(12, 1), F.lit("-"), number(28, 1))
    clock = F.concat(number(24, 0), F.lit(":"), number(60, 0), F.lit(":05"))

    def meta(key: str, value: Column) -> Column:
        return F.concat(F.lit(f"<meta {key} content=\""), value, F.lit('">'))

    published = 'property="article:published_time"'
    return case(
        7,
        meta(published, F.concat(ymd, F.lit("T"), clock, F.lit(".000Z"))),
        meta(
            'name="OriginalPublicationDate"',
            F.concat(F.lit("Mon, "), number(28, 1), F.lit(" Dec 2025 "), clock, F.lit(" +0200")),
        ),
        F.concat(
            meta(published, F.lit("")), F.lit('<time datetime="'), ymd, F.lit('">then</time>')
        ),
        F.concat(F.lit('<time>today</time><time datetime="'), ymd, F.lit('">then</time>')),
        meta(published, F.col("source")),
        F.concat(
            meta('name="OriginalPublicationDate"', F.concat(ymd, F.lit(" "), clock)),
            meta(published, F.concat(ymd, F.lit("T"), clock, F.lit(".25-0330"))),
        ),
        "",
    )


def json_script(fields: Column) -> Column:
    return F.concat(
        F.lit('<script type="application/ld+json">'),
        F.replace(F.to_json(fields), F.lit("<"), F.lit("\\u003c")),
        F.lit("</script>"),
    )


def article_json(kind: str, body: Column) -> Column:
    return F.struct(F.lit(kind).alias("@type"), body.alias("articleBody"))


def render_heads(docs: DataFrame) -> DataFrame:
    """Pages with every kind of metadata and the text as article paragraphs."""
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>t</title>"),
        canonical_html(), author_html(), image_html(), tags_html(),
        F.lit("</head><body><article>"), title_html(), date_html(), paragraphs_html(),
        F.lit("</article>"), furniture_html(), F.lit("</body></html>"),
    )
    return docs.select(
        F.col("doc_id").alias("page_id"), request_url().alias("url"), html.alias("html")
    )


def render_split(docs: DataFrame) -> DataFrame:
    """Pages with an article of a text's lines in three sections, the first the longest."""
    def section(inner: Column) -> Column:
        return F.concat(F.lit("<section>"), inner, F.lit("</section>"))

    lines = paragraphs_html()
    html = F.concat(
        F.lit("<html><body><div>"), section(F.concat(lines, lines, lines)),
        F.lit("<aside><p>"), F.col("lang"), F.lit(" see also</p></aside>"), section(lines), section(lines), F.lit("</div></body></html>"),
    )
    return docs.select(F.col("doc_id").alias("page_id"), request_url().alias("url"), html.alias("html"))


def amp_url() -> Column:
    return F.concat(F.lit("https://amp.example.com/"), F.col("lang"), F.lit("/"), doc_text())


def render_bodies(docs: DataFrame) -> DataFrame:
    """Pages whose text sits in a different place each, with their AMP twins.

    The JSON-LD body of kind 3 stands under a key that is there twice.

    0: article paragraphs; 1: JSON-LD only; 2: first line, and an AMP twin with
    all lines; 3: article paragraphs, and a longer JSON-LD body after an
    invalid one; 4: as 2, but the AMP link carries a tracking key and so names
    no landed page; 5: bare paragraphs.
    """
    first = F.concat(F.lit("<p>"), escaped(F.split_part("text", F.lit("\n"), F.lit(1))), F.lit("</p>"))
    twice = F.concat_ws(" ", "text", "text")
    amp = F.concat(F.lit('<link rel="amphtml" href="'), amp_url(), F.lit('">'))
    tracked = F.concat(F.lit('<link rel="amphtml" href="'), amp_url(), F.lit('?utm_source=x">'))

    def article(inner: Column) -> Column:
        return F.concat(F.lit("<article>"), inner, F.lit("</article>"))

    html = case(
        6,
        F.concat(article(paragraphs_html()), furniture_html()),
        F.concat(
            F.lit('<script type="application/ld+json">{broken</script>'),
            json_script(F.array(article_json("WebPage", twice), article_json("Article", F.col("text")))),
        ),
        F.concat(amp, article(first)),
        F.concat(
            json_script(F.struct(F.array(F.lit("NewsArticle")).alias("@type"), twice.alias("articleBody"))),
            json_script(F.struct(F.lit("Article").alias("@type"), F.col("doc_id").alias("articleBody"))),
            F.replace(
                json_script(article_json("NewsArticle", twice)),
                F.lit('"articleBody":'), F.lit('"articleBody":"not this","articleBody":'),
            ),
            article(paragraphs_html()),
        ),
        F.concat(tracked, article(first)),
        F.concat(F.lit("<div>"), paragraphs_html(), F.lit("</div>")),
    )
    own = docs.select(
        F.col("doc_id").alias("page_id"),
        request_url().alias("url"),
        F.concat(F.lit("<html><body>"), html, F.lit("</body></html>")).alias("html"),
    )
    twins = docs.filter((F.col("doc_id") % 6).isin(2, 4)).select(
        (-F.col("doc_id") - 1).alias("page_id"),
        amp_url().alias("url"),
        F.concat(F.lit("<html amp><main>"), paragraphs_html(), furniture_html(), F.lit("</main></html>")).alias(
            "html"
        ),
    )
    return own.unionByName(twins)


def render_twins(docs: DataFrame) -> DataFrame:
    """Pages with the first line of a text, and AMP twins with all of it, in two landings (``part``).

    0: the twin lands later; 1: the twin lands first; 2: both land at once; 3: the
    twin never lands.
    """
    first = F.concat(F.lit("<p>"), escaped(F.split_part("text", F.lit("\n"), F.lit(1))), F.lit("</p>"))

    def page(head: Column, title: Column, body: Column) -> Column:
        return F.concat(
            F.lit("<html><head>"), head, F.lit("</head><body><article><h1>"), title, F.lit("</h1>"), body,
            F.lit("</article></body></html>"),
        )

    kind = F.col("doc_id") % 4
    amp = F.concat(F.lit('<link rel="amphtml" href="'), amp_url(), F.lit('">'))
    own = docs.select(
        F.col("doc_id").alias("page_id"),
        request_url().alias("url"),
        page(amp, doc_text(), first).alias("html"),
        F.when(kind == 1, 2).otherwise(1).alias("part"),
    )
    twins = docs.filter(kind != 3).select(
        (-F.col("doc_id") - 1).alias("page_id"),
        amp_url().alias("url"),
        page(F.lit(""), F.concat(F.lit("amp "), doc_text()), paragraphs_html()).alias("html"),
        F.when(kind == 0, 2).otherwise(1).alias("part"),
    )
    return own.unionByName(twins)


def entry_link() -> Column:
    """Link of a feed entry: missing, empty, broken, that of a neighbour, or its own."""
    target = F.when(F.col("doc_id") % 9 == 4, F.col("doc_id") - 1).otherwise(F.col("doc_id"))
    own = F.concat(
        F.lit("https://News.example.com/"), target.cast("string"), F.lit("/?at_medium=rss#x")
    )
    return (
        F.when(F.col("doc_id") % 13 == 3, F.lit(None))
        .when(F.col("doc_id") % 13 == 5, F.lit(""))
        .when(F.col("doc_id") % 13 == 7, F.concat(F.lit("http://[broken/"), doc_text()))
        .otherwise(own)
    )


def feed_ordinal() -> Column:
    return F.floor(F.col("doc_id") / FEED_RUN).cast("int")


def feed_url(ordinal: Column) -> Column:
    return F.concat(F.lit("https://feeds.example.com/"), ordinal.cast("string"))


def render_feeds(docs: DataFrame) -> DataFrame:
    """Feed documents: RSS and Atom in turn; of ten, one is malformed and one is no feed."""
    link = escaped(entry_link())
    description = F.concat(F.lit("<description>"), escaped(F.col("text")), F.lit("</description>"))
    rss = F.concat(
        F.lit("<item><title>"), doc_text(), F.lit("</title>"),
        F.coalesce(F.concat(F.lit("<link>"), link, F.lit("</link>")), F.lit("")),
        description, F.lit("</item>"),
    )
    atom = F.concat(
        F.lit('<entry><link rel="self" href="https://feeds.example.com/self"/>'),
        F.coalesce(F.concat(F.lit('<link href="'), link, F.lit('"/>')), F.lit("")),
        F.lit("<id>"), doc_text(), F.lit("</id>"), description, F.lit("</entry>"),
    )
    items = (
        docs.withColumn("f", feed_ordinal())
        .withColumn("item", F.when(F.col("f") % 2 == 0, rss).otherwise(atom))
        .groupBy("f")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "item"))).alias("items"))
        .withColumn("body", F.array_join(F.transform("items", lambda i: i["item"]), ""))
    )
    xml = (
        F.when(F.col("f") % 10 == 8, F.concat(F.lit("no feed: "), F.replace("body", F.lit("<"), F.lit(" "))))
        .when(F.col("f") % 10 == 9, F.concat(F.lit("<rss><channel><item>"), F.col("body")))
        .when(
            F.col("f") % 2 == 0,
            F.concat(
                F.lit('<rss version="2.0"><channel><title>t</title>'), F.col("body"),
                F.lit("</channel></rss>"),
            ),
        )
        .otherwise(
            F.concat(
                F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title>'),
                F.col("body"), F.lit("</feed>"),
            )
        )
    )
    return items.select(feed_url(F.col("f")).alias("feed_url"), xml.alias("xml"))


def render_feed_config(docs: DataFrame) -> DataFrame:
    """Configured feeds in three profiles, one per policy.

    One row for each rendered feed, and for every tenth another feed that has
    not landed.
    """
    f = F.col("feed_ord")
    numbers = docs.select(feed_ordinal().alias("feed_ord")).distinct()
    missing = numbers.filter(f % 10 == 0).select((f + NOT_LANDED).alias("feed_ord"))

    def by_profile(*values: str | None) -> Column:
        out = F.lit(None).cast("string")
        for i, v in enumerate(values):
            out = F.when(f % 3 == i, F.lit(v)).otherwise(out)
        return out

    return (
        numbers.unionByName(missing)
        .select(
            by_profile("constant", "host", "label").alias("profile"),
            "feed_ord",
            F.concat(F.lit("c"), (f % 4).cast("string")).alias("category"),
            feed_url(f).alias("feed_url"),
            F.lit(None).cast("int").alias("max_per_feed"),
            by_profile("constant", "host", "first_label").alias("source_policy"),
            by_profile("Wire", None, None).alias("source_value"),
            by_profile("four", "four", "three").alias("selector_policy"),
        )
    )


def render_landed(docs: DataFrame) -> DataFrame:
    """Landed pages of the feed entries: some twice, some failed, some not at all."""
    html = F.concat(
        F.lit("<html><head>"), author_html(), image_html(), tags_html(),
        F.lit("</head><body><article><h1>"), F.col("lang"), F.lit("</h1>"), date_html(),
        paragraphs_html(), F.lit("</article></body></html>"),
    )
    at = F.concat(F.lit("https://news.example.com/"), doc_text())
    current = docs.filter(F.col("doc_id") % 11 != 6).select(
        (F.col("doc_id") * 2 + 1).alias("page_id"),
        F.concat(at, F.lit("?utm_term=a")).alias("url"),
        html.alias("html"),
        F.when(F.col("doc_id") % 11 == 8, 500).otherwise(200).alias("status"),
        F.lit(2).alias("fetched_at"),
    )
    older = docs.filter(F.col("doc_id") % 3 == 1).select(
        (F.col("doc_id") * 2).alias("page_id"),
        F.concat(at, F.lit("/")).alias("url"),
        F.lit("<p>old landing</p>").alias("html"),
        F.lit(None).cast("int").alias("status"),
        F.lit(1).alias("fetched_at"),
    )
    return current.unionByName(older)


def document_articles(docs: DataFrame, profile: Column | None = None) -> DataFrame:
    """Article rows straight from documents; three neighbours share an address."""
    url = F.concat(
        F.lit("https://news.example.com/"), F.floor(F.col("doc_id") / 3).cast("string")
    )
    return docs.select(
        article_id(url).alias("id_article"),
        F.col("lang").alias("title"),
        case(2, F.concat_ws(", ", "lang", "source"), F.lit(None)).alias("tags"),
        F.col("text").alias("content"),
        url.alias("url"),
        F.col("lang").alias("category"),
        F.col("source").alias("source"),
        case(3, F.lit(""), F.concat(F.lit('say "'), F.col("lang"), F.lit('", \\')), F.lit(None)).alias(
            "author"
        ),
        F.lit(None).cast("string").alias("image"),
        F.lit("2025-12-01T10:00:00+02:00").alias("published_date"),
        content_hash(F.col("lang"), F.col("text")).alias("content_hash"),
        (F.lit("all") if profile is None else profile).alias("profile"),
        F.lit(0).alias("feed_ord"),
        F.col("doc_id").alias("entry_ord"),
        F.lit("2025-12-01 08:00:00+00:00").cast("timestamp").alias("published_ts"),
    )
