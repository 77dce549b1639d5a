"""Feed configuration, feed documents and their entries."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.text import let
from newsloom.functions.urls import normalized_url
from newsloom.schemas import FEED_SCHEMA

# Per profile the source policy, the source value, the selector
# policy and the feeds in order (a story in two feeds belongs to the first).
# The "times" profile carries a source label that does not fit its feeds; it is
# configuration and can be changed here.
PROFILES = {
    "broadcaster": (
        "constant", "BBC", "four",
        (
            ("Politics", "https://feeds.bbci.co.uk/news/politics/rss.xml"),
            ("World (International)", "https://feeds.bbci.co.uk/news/world/rss.xml"),
            ("Science", "https://feeds.bbci.co.uk/news/science_and_environment/rss.xml"),
            ("Health", "https://feeds.bbci.co.uk/news/health/rss.xml"),
            ("Sports", "https://feeds.bbci.co.uk/sport/rss.xml?edition=uk"),
            ("Entertainment", "https://feeds.bbci.co.uk/news/entertainment_and_arts/rss.xml"),
            ("Culture", "https://www.bbc.com/culture/feed.rss"),
            ("Society", "https://feeds.bbci.co.uk/news/uk/rss.xml"),
        ),
    ),
    "broadcaster_politics": (
        "constant", "BBC", "four",
        (("Politics", "https://feeds.bbci.co.uk/news/politics/rss.xml"),),
    ),
    "daily": (
        "constant", "the guardians", "four",
        (
            ("politics", "https://www.theguardian.com/politics/rss"),
            ("World", "https://www.theguardian.com/world/rss"),
            ("Business", "https://www.theguardian.com/uk/business/rss"),
            ("Technology", "https://www.theguardian.com/uk/technology/rss"),
            ("Science", "https://www.theguardian.com/science/rss"),
            ("Health", "https://www.theguardian.com/society/health/rss"),
            ("Sport", "https://www.theguardian.com/uk/sport/rss"),
            ("Entertainment", "https://www.rollingstone.com/culture/feed/"),
            ("Culture", "https://www.theguardian.com/culture/rss"),
            ("Society", "https://www.theguardian.com/society/rss"),
        ),
    ),
    "times": (
        "constant", "BBC", "four",
        (
            ("politics", "https://rss.nytimes.com/services/xml/rss/nyt/Politics.xml"),
            ("World", "https://rss.nytimes.com/services/xml/rss/nyt/World.xml"),
            ("Business", "https://rss.nytimes.com/services/xml/rss/nyt/Business.xml"),
            ("Technology", "https://rss.nytimes.com/services/xml/rss/nyt/Technology.xml"),
            ("Science", "https://rss.nytimes.com/services/xml/rss/nyt/Science.xml"),
            ("Health", "https://rss.nytimes.com/services/xml/rss/nyt/Health.xml"),
            ("Sport", "https://rss.nytimes.com/services/xml/rss/nyt/Sports.xml"),
            ("Entertainment", "https://rss.nytimes.com/services/xml/rss/nyt/Movies.xml"),
            ("Culture", "https://rss.nytimes.com/services/xml/rss/nyt/Arts.xml"),
            ("Society", "https://rss.nytimes.com/services/xml/rss/nyt/Opinion.xml"),
        ),
    ),
    "mixed_by_host": (
        "host", None, "four",
        (
            ("Politics", "https://thehill.com/feed/"),
            ("World", "https://www.aljazeera.com/xml/rss/all.xml"),
            ("Business", "https://www.marketwatch.com/feeds/topstories"),
            ("Technology", "https://www.wired.com/feed/rss"),
            ("Science", "https://www.livescience.com/feeds/all"),
            ("Health", "https://feeds.npr.org/1128/rss.xml"),
            ("Sport", "https://www.cbssports.com/rss/headlines/"),
            ("Entertainment", "https://variety.com/feed/"),
            ("Culture", "https://www.npr.org/rss/rss.php?id=1008"),
            ("Society", "https://theconversation.com/us/articles.atom"),
            ("Innovation", "https://www.arstechnica.com/feed/"),
            ("Environment", "https://www.aljazeera.com/xml/rss/themes/environment.xml"),
        ),
    ),
    "mixed_by_label": (
        "first_label", None, "three",
        (
            ("Politics", "https://feeds.npr.org/1014/rss.xml"),
            ("World", "https://www.reuters.com/rssFeed/worldNews"),
            ("Business", "https://www.cnbc.com/id/10001147/device/rss"),
            ("Technology", "https://www.engadget.com/rss.xml"),
            ("Science", "https://www.sciencemag.org/rss/news_current.xml"),
            ("Health", "https://www.statnews.com/feed/"),
            ("Sport", "https://www.espn.com/espn/rss/news"),
            ("Entertainment", "https://www.rollingstone.com/culture/feed/"),
            ("Culture", "https://feeds.npr.org/1008/rss.xml"),
            ("Society", "https://www.npr.org/rss/rss.php?id=1128"),
        ),
    ),
}

_LINK = T.StructType(
    [
        T.StructField("_href", T.StringType()),
        T.StructField("_rel", T.StringType()),
        T.StructField("_VALUE", T.StringType()),
    ]
)
_GUID = T.StructType(
    [T.StructField("_isPermaLink", T.StringType()), T.StructField("_VALUE", T.StringType())]
)
_ITEM = T.StructType([T.StructField("link", T.ArrayType(_LINK)), T.StructField("guid", _GUID)])
# One schema reads RSS (channel/item, or item next to the channel) and Atom (entry).
_FEED_XML = T.StructType(
    [
        T.StructField("channel", T.StructType([T.StructField("item", T.ArrayType(_ITEM))])),
        T.StructField("item", T.ArrayType(_ITEM)),
        T.StructField("entry", T.ArrayType(_ITEM)),
    ]
)


def feed_config(
    spark: SparkSession, profiles: dict = PROFILES, max_per_feed: int | None = None
) -> DataFrame:
    """One row per configured feed; NULL in ``max_per_feed`` takes every entry."""
    rows = [
        (profile, ordinal, category, url, max_per_feed, policy, value, selector)
        for profile, (policy, value, selector, feeds) in profiles.items()
        for ordinal, (category, url) in enumerate(feeds)
    ]
    return spark.createDataFrame(rows, FEED_SCHEMA)


def _rss_link(item: Column) -> Column:
    return F.get(F.filter(item["link"], lambda x: x["_VALUE"].isNotNull()), F.lit(0))["_VALUE"]


def _permalink(item: Column) -> Column:
    """The guid, which is the item's address unless it says otherwise."""
    guid = item["guid"]
    kept = F.lower(F.coalesce(guid["_isPermaLink"], F.lit("true"))) != "false"
    return F.when(kept, F.nullif(guid["_VALUE"], F.lit("")))


def _atom_link(item: Column) -> Column:
    main = F.filter(
        item["link"], lambda x: x["_rel"].isNull() | (x["_rel"] == "alternate")
    )
    return F.nullif(F.get(main, F.lit(0))["_href"], F.lit(""))


def _whole_length(cap: Column | int) -> Column:
    limit = F.lit(cap) if isinstance(cap, int) else cap
    return F.coalesce(limit.cast("int"), F.lit(2**31 - 1))


def _any_link(item: Column) -> Column:
    return F.coalesce(_rss_link(item), _atom_link(item), _permalink(item))


def _salvaged(xml: Column) -> Column:
    """Closed items of a document that is not well-formed as a whole, read one by one."""
    name = F.when(F.contains(xml, F.lit("</item>")), "item").otherwise("entry")

    def closed(name: Column) -> Column:
        end = F.concat(F.lit("</"), name, F.lit(">"))
        parts = F.split(xml, F.concat(F.lit("<"), name, F.lit(r"(?=[\s>])")))
        bodies = F.filter(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda p: F.contains(p, end))
        return F.transform(
            bodies,
            lambda p: F.from_xml(
                F.concat(F.lit("<"), name, F.call_function("substring_index", p, end, F.lit(1)), end), _ITEM, {"mode": "PERMISSIVE"}
            ),
        )

    return let(name, closed)


def entry_links(xml: Column, cap: Column | int | None = None) -> Column:
    """Links of the first ``cap`` entries in document order; NULL where missing or empty.

    NULL for a document in which no entry can be read.  The cut is made on the
    array, before any row is produced; without ``cap`` there is none.  Of a
    document that is not well-formed the closed items are read; one that cannot
    be read itself has no link.
    """
    length = _whole_length(F.lit(None) if cap is None else cap)

    def read(doc: Column) -> Column:
        rss = F.coalesce(doc["channel"]["item"], doc["item"])
        whole = F.coalesce(
            F.transform(F.slice(rss, 1, length), _any_link),
            F.transform(F.slice(doc["entry"], 1, length), _atom_link),
        )
        return F.coalesce(whole, let(_salvaged(xml), some))

    def some(items: Column) -> Column:
        return F.when(F.size(items) > 0, F.transform(F.slice(items, 1, length), _any_link))

    return let(F.from_xml(xml, _FEED_XML, {"mode": "PERMISSIVE"}), read)


def newest_feeds(feed_docs: DataFrame) -> DataFrame:
    """One document per feed: the latest landing; without ``fetched_at``, or on a tie, the greater text."""
    stamp = F.col("fetched_at") if "fetched_at" in feed_docs.columns else F.lit(0)
    newest = F.max(F.struct(stamp.alias("at"), F.col("xml").alias("xml")))
    return feed_docs.groupBy("feed_url").agg(newest["xml"].alias("xml"))


_ENTRY = ("category", "source_policy", "source_value", "selector_policy")


def read_feeds(feed_docs: DataFrame, feeds: DataFrame, cap: int | None = None) -> DataFrame:
    """Configured feeds with their ``links`` and, for those without, the ``outcome``; each document is parsed here only.

    A feed that landed several times is read as it landed last.  ``outcome`` is
    ``no_feed`` (not landed), ``bad_feed`` (not readable) or NULL; a feed that can be
    read and is empty is neither.  ``feeds`` is left to Spark's own size check: the
    configuration table is a local relation of known size.
    """
    newest = newest_feeds(feed_docs).withColumn("landed", F.lit(True))
    joined = feeds.join(newest, "feed_url", "left")
    limit = F.col("max_per_feed") if cap is None else F.lit(cap)
    outcome = F.when(F.col("landed").isNull(), "no_feed").when(
        F.col("links").isNull() & ~_is_feed(F.col("xml")), "bad_feed"
    )
    return (
        joined.withColumn("links", entry_links(F.col("xml"), limit))
        .withColumn("outcome", outcome)
        .select("profile", "feed_ord", *_ENTRY, "links", "outcome")
    )


def read_entries(read: DataFrame) -> DataFrame:
    """Entries of feeds that ``read_feeds`` has read, with or without a link."""
    return read.select("profile", "feed_ord", *_ENTRY, F.posexplode("links").alias("pos", "link")).select(
        "profile", "feed_ord", F.col("pos").cast("long").alias("entry_ord"), "category", "link", *_ENTRY[1:]
    )


def read_failures(read: DataFrame) -> DataFrame:
    """The feeds of ``read_feeds`` that could not be read, with the ``outcome``."""
    return read.select("profile", "feed_ord", "category", "outcome").filter(F.col("outcome").isNotNull())


def all_feed_entries(feed_docs: DataFrame, feeds: DataFrame, cap: int | None = None) -> DataFrame:
    """Entries of all configured feeds, capped per feed if asked for, with or without a link."""
    return read_entries(read_feeds(feed_docs, feeds, cap))


def failed_feeds(feed_docs: DataFrame, feeds: DataFrame) -> DataFrame:
    """Configured feeds that give no entry: ``no_feed`` (not landed) or ``bad_feed`` (not readable)."""
    return read_failures(read_feeds(feed_docs, feeds))


def _is_feed(xml: Column) -> Column:
    """Whether a document without entries is a feed all the same."""
    return F.coalesce(xml.rlike(r"(?is)<(rss|feed|rdf)[\s>:].*</(rss|feed|rdf)(:rdf)?>\s*$"), F.lit(False))


def linked(entries: DataFrame) -> DataFrame:
    """Drop entries without a link; they have already used up their slot."""
    return entries.filter(F.col("link").isNotNull() & (F.col("link") != ""))


def with_link_outcome(entries: DataFrame) -> DataFrame:
    """Add ``norm_url`` and, for a link that cannot be read, ``reject_reason``."""
    return entries.withColumn("norm_url", normalized_url(F.col("link"))).withColumn(
        "reject_reason", F.when(F.col("norm_url").isNull(), "bad_link")
    )


def feed_entries(feed_docs: DataFrame, feeds: DataFrame, cap: int | None = None) -> DataFrame:
    return linked(all_feed_entries(feed_docs, feeds, cap))


def cap_entries(entries: DataFrame, cap: int) -> DataFrame:
    """First entries per feed of an already exploded table.

    Spark cuts each map task's part of a feed to ``cap`` rows before the
    shuffle, so a feed of any length sends a bounded number of rows on.
    """
    position = Window.partitionBy("profile", "feed_ord").orderBy("entry_ord")
    return (
        entries.withColumn("_n", F.row_number().over(position))
        .filter(F.col("_n") <= cap)
        .drop("_n")
    )
