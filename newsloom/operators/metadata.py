"""Title, author, image, tags, dates and links of a page, from its nodes.

Element presence, attribute presence and an empty value are three different
things here: a chosen element stays NULL only if it is absent.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import iso_date, iso_timestamp
from newsloom.functions.text import article_id, tag_list
from newsloom.functions.urls import normalized_url
from newsloom.operators.dom import attribute, first_node, visible_pieces

_HEAD_TAGS = ("link", "meta", "time", "h1", "script")
_LD_JSON = "application/ld+json"


def _meta(heads: Column, key: str, value: str) -> Column:
    return first_node(heads, lambda n: (n["tag"] == "meta") & (attribute(n, key) == value))


def _link(heads: Column, rel: str) -> Column:
    found = first_node(
        heads,
        lambda n: (n["tag"] == "link")
        & F.array_contains(F.split(attribute(n, "rel"), r"\s+"), rel),
    )
    return attribute(found, "href")


def _filled(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def with_metadata(nodes_df: DataFrame, url_col: str = "url") -> DataFrame:
    """Add the metadata columns; ``nodes`` stays for the body steps.

    ``url`` becomes the page's own canonical address if it names one, else its
    normalised request address, and is NULL if that address cannot be read.
    ``request_url`` keeps the address the page was asked for.
    """
    picked = nodes_df.withColumnRenamed(url_col, "request_url").withColumn(
        "heads", F.filter("nodes", lambda n: n["tag"].isin(*_HEAD_TAGS))
    )
    heads, nodes = F.col("heads"), F.col("nodes")
    chosen = picked.select(
        "*",
        first_node(heads, lambda n: n["tag"] == "h1").alias("h1"),
        attribute(_meta(heads, "property", "og:title"), "content").alias("og_title"),
        F.coalesce(_meta(heads, "name", "byl"), _meta(heads, "name", "author")).alias("byline"),
        attribute(_meta(heads, "property", "og:image"), "content").alias("image"),
        F.coalesce(_meta(heads, "name", "news_keywords"), _meta(heads, "name", "keywords")).alias(
            "keywords"
        ),
        F.coalesce(
            _filled(attribute(_meta(heads, "property", "article:published_time"), "content")),
            _filled(attribute(_meta(heads, "name", "OriginalPublicationDate"), "content")),
            _filled(attribute(first_node(heads, lambda n: n["tag"] == "time"), "datetime")),
        ).alias("date_text"),
        _filled(_link(heads, "canonical")).alias("canonical_href"),
        _filled(_link(heads, "amphtml")).alias("amp_href"),
        F.transform(
            F.filter(heads, lambda n: (n["tag"] == "script") & (attribute(n, "type") == _LD_JSON)),
            # A script's text is its only child; an empty script has none.
            lambda n: F.when(
                n["last_id"] > n["node_id"], F.get(nodes, n["node_id"] + 1)["text"]
            ),
        ).alias("ld_json"),
    )
    shaped = chosen.select(
        *[c for c in nodes_df.columns if c != url_col],
        "request_url",
        F.when(
            F.col("h1").isNotNull(), F.array_join(visible_pieces(nodes, F.col("h1")), "")
        )
        .otherwise(F.coalesce("og_title", F.lit("")))
        .alias("title"),
        attribute(F.col("byline"), "content").alias("author"),
        "image",
        tag_list(attribute(F.col("keywords"), "content")).alias("tags"),
        iso_date(F.col("date_text")).alias("published_date"),
        F.transform(
            F.array(F.coalesce("canonical_href", "request_url"), "request_url"), normalized_url
        ).alias("norms"),
        "amp_href",
        "ld_json",
    )
    # An unreadable canonical address fails the page; it does not fall back.
    canonical, requested = F.col("norms")[0], F.col("norms")[1]
    return (
        shaped.withColumn("norm_url", requested)
        .withColumn(
            "url", F.when(canonical.isNotNull(), F.coalesce(_filled(canonical), requested))
        )
        .drop("norms")
        .withColumn("id_article", article_id(F.col("url")))
        .withColumn("published_ts", iso_timestamp(F.col("published_date")))
    )
