"""Article bodies embedded as JSON-LD."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let, strip_space
from newsloom.schemas import MIN_BODY_CHARS

# Object types that carry an article body.
_ARTICLE_TYPES = ("NewsArticle", "Article")


def _article(kind: Column, body: Column) -> Column:
    return F.struct(kind.alias("kind"), body.alias("body"))


def _strict(script: Column) -> Column:
    """Type and body of the objects of a script; NULL if it is not valid or repeats a key."""

    def read(doc: Column) -> Column:
        objects = F.coalesce(F.try_variant_get(doc, "$", "array<variant>"), F.array(doc))
        return F.transform(
            objects,
            lambda o: _article(
                F.try_variant_get(o, "$['@type']", "string"), F.try_variant_get(o, "$.articleBody", "variant")
            ),
        )

    # The parser stops after the first value.  A second element is appended, and
    # both must come back: text after the value then makes the script invalid.
    closed = F.try_parse_json(F.concat(F.lit("["), script, F.lit(",0]")))
    values = F.try_variant_get(closed, "$", "array<variant>")
    one = let(values, lambda v: F.when(F.size(v) == 2, F.get(v, F.lit(0))))
    return let(one, lambda doc: F.when(doc.isNotNull(), read(doc)))


def _last_values(script: Column) -> Column:
    """As ``_strict`` for objects that repeat a key: the last value counts.

    Read with a schema, an object keeps the last value of each key.  An element that only
    the end of the script can close is appended, as above.
    """
    item = "struct<`@type`: variant, articleBody: variant, `#end`: boolean>"

    def read(end: str, schema: str) -> Column:
        return F.from_json(F.concat(F.lit("["), script, F.lit(f",{end}]")), schema)

    one = let(
        read('{"#end":true}', f"array<{item}>"),
        lambda v: F.when((F.size(v) == 2) & F.get(v, F.lit(1))["#end"], F.slice(v, 1, 1)),
    )
    many = let(
        read('[{"#end":true}]', f"array<array<{item}>>"),
        lambda v: F.when((F.size(v) == 2) & F.get(F.get(v, F.lit(1)), F.lit(0))["#end"], F.get(v, F.lit(0))),
    )
    return F.transform(
        F.coalesce(one, many),
        lambda o: _article(F.try_variant_get(o["@type"], "$", "string"), o["articleBody"]),
    )


def _bodies(script: Column) -> Column:
    """Body texts of the article objects in one script, in order."""
    articles = F.filter(
        F.coalesce(_strict(script), _last_values(script)),
        lambda a: a["kind"].isin(*_ARTICLE_TYPES) & (F.schema_of_variant(a["body"]) == "STRING"),
    )
    return F.transform(articles, lambda a: F.try_variant_get(a["body"], "$", "string"))


def longest_body(scripts: Column, start: Column, min_chars: int = MIN_BODY_CHARS) -> Column:
    """Fold the scripts into ``start``; a script is read only while it is short."""

    def take(text: Column, script: Column) -> Column:
        longer = F.reduce(
            _bodies(script),
            text,
            lambda t, body: F.when(F.length(body) > F.length(t), strip_space(body)).otherwise(t),
        )
        return F.when(
            F.length(text) < min_chars, F.coalesce(longer, text)
        ).otherwise(text)

    return F.reduce(scripts, start, take)


def jsonld_body(nodes_df: DataFrame, out: str = "jsonld_text") -> DataFrame:
    """Add the JSON-LD body found on its own, without earlier stages."""
    return nodes_df.withColumn(out, longest_body(F.col("ld_json"), F.lit("")))
