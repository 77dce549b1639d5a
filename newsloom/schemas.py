"""Table schemas shared by every part of the library."""

from pyspark.sql import types as T

# The article row, in output order.
ARTICLE_COLUMNS = (
    "id_article",
    "title",
    "tags",
    "content",
    "url",
    "category",
    "source",
    "author",
    "image",
    "published_date",
    "content_hash",
)

ARTICLE_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ARTICLE_COLUMNS])

# The store keeps the scope and the position an article was accepted at, and a
# typed publication time; the CSV export leaves these out.
STORE_SCHEMA = T.StructType(
    list(ARTICLE_SCHEMA.fields)
    + [
        T.StructField("profile", T.StringType()),
        T.StructField("feed_ord", T.IntegerType()),
        T.StructField("entry_ord", T.LongType()),
        T.StructField("published_ts", T.TimestampType()),
    ]
)

FEED_SCHEMA = T.StructType(
    [
        T.StructField("profile", T.StringType()),
        T.StructField("feed_ord", T.IntegerType()),
        T.StructField("category", T.StringType()),
        T.StructField("feed_url", T.StringType()),
        T.StructField("max_per_feed", T.IntegerType()),
        T.StructField("source_policy", T.StringType()),
        T.StructField("source_value", T.StringType()),
        T.StructField("selector_policy", T.StringType()),
    ]
)

# One element or text piece of a page; node_id is its position in the array.
NODE_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("node_id", T.IntegerType()),
            T.StructField("parent_id", T.IntegerType()),
            T.StructField("last_id", T.IntegerType()),
            T.StructField("within", T.IntegerType()),
            T.StructField("tag", T.StringType()),
            T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
            T.StructField("text", T.StringType()),
        ]
    )
)

# Thresholds of the body cascade and the length of an id.
MIN_BODY_CHARS = 800
THIN_CHARS = 200
MIN_PARAGRAPH_CHARS = 3
ID_CHARS = 12
