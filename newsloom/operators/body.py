"""The body cascade: main block, selected paragraphs, JSON-LD, AMP twin."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let
from newsloom.operators.amp import with_amp_body
from newsloom.operators.jsonld import longest_body
from newsloom.operators.main_content import main_text
from newsloom.operators.paragraphs import clean_join, paragraph_texts
from newsloom.schemas import MIN_BODY_CHARS
from newsloom.sources.staging import stage_counted

# "full" starts with the main block, "selectors" with the selected paragraphs.
CONTENT_POLICIES = ("full", "selectors")


def _prefer_longer(text: Column, candidate: Column, min_chars: int) -> Column:
    """``candidate`` is only evaluated while ``text`` is short."""
    longer = let(
        candidate, lambda c: F.when(F.length(c) > F.length(text), c).otherwise(text)
    )
    return F.when(F.length(text) < min_chars, longer).otherwise(text)


def page_body(
    nodes_df: DataFrame,
    content_policy: str = "full",
    selector_policy: Column | str = "four",
    min_chars: int = MIN_BODY_CHARS,
    out: str = "body",
) -> DataFrame:
    """Stages that need only the page itself; narrow, ``nodes`` is dropped."""
    if content_policy not in CONTENT_POLICIES:
        raise ValueError(f"unknown content policy {content_policy!r}")
    nodes = F.col("nodes")
    first = main_text(nodes) if content_policy == "full" else F.lit("")
    candidate = clean_join(paragraph_texts(nodes, selector_policy))
    body = let(
        let(first, lambda text: _prefer_longer(text, candidate, min_chars)),
        lambda text: longest_body(F.col("ld_json"), text, min_chars),
    )
    return nodes_df.withColumn(out, body).drop("nodes", "ld_json")


def article_body(
    nodes_df: DataFrame,
    pages: DataFrame | None = None,
    content_policy: str = "full",
    selector_policy: Column | str = "four",
    min_chars: int = MIN_BODY_CHARS,
    out: str = "body",
) -> DataFrame:
    """Add the body text.

    The page's own stages run once and are staged; with ``pages`` given, rows
    that are still short are then looked up by their AMP address.
    """
    own = stage_counted(page_body(nodes_df, content_policy, selector_policy, min_chars, out), "body")
    if pages is None:
        return own
    return with_amp_body(own, pages, out, min_chars=min_chars)
