"""Pages to article rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import content_hash
from newsloom.functions.urls import first_segment, source_name
from newsloom.operators.amp import twin_rows, with_amp_body
from newsloom.operators.body import page_body
from newsloom.operators.dom import dom_nodes
from newsloom.operators.metadata import with_metadata
from newsloom.schemas import MIN_BODY_CHARS, THIN_CHARS
from newsloom.sources.pages import loaded_pages
from newsloom.sources.staging import stage_counted


def own_articles(
    pages: DataFrame,
    selector_policy: str | list[str] = "four",
    content_policy: str = "full",
    min_chars: int = MIN_BODY_CHARS,
    thin_chars: int = THIN_CHARS,
    more: Sequence[Column] = (),
) -> DataFrame:
    """``page_articles`` before AMP twins are looked up, with ``amp_href`` and the columns ``more``; staged."""
    policies = [selector_policy] if isinstance(selector_policy, str) else selector_policy
    wanted = loaded_pages(pages).select("page_id", "url", "html")
    meta = with_metadata(dom_nodes(wanted))
    if len(policies) == 1:
        meta = meta.withColumn("selector_policy", F.lit(policies[0]))
        policy: str | Column = policies[0]
    else:
        meta = meta.withColumn("selector_policy", F.explode(F.array(*map(F.lit, policies))))
        policy = F.col("selector_policy")
    body = page_body(meta, content_policy, policy, min_chars, "content")
    return stage_counted(judged(body.drop("request_url"), thin_chars).select("*", *more), "pages")


def judged(rows: DataFrame, thin_chars: int = THIN_CHARS) -> DataFrame:
    """Renew what depends on the text: ``content_hash`` and ``reject_reason``."""
    reason = (
        F.when(F.col("norm_url").isNull(), "bad_link")
        .when(F.col("url").isNull(), "bad_canonical")
        .when(F.length("content") < thin_chars, "thin")
    )
    return rows.withColumn("content_hash", content_hash(F.col("title"), F.col("content"))).withColumn(
        "reject_reason", reason
    )


def with_twins(
    rows: DataFrame, lookup: DataFrame, min_chars: int = MIN_BODY_CHARS, thin_chars: int = THIN_CHARS
) -> DataFrame:
    """``own_articles`` whose short texts are replaced by longer ones of the AMP twins in ``lookup``."""
    return with_amp_body(rows, lookup, "content", min_chars=min_chars, derive=lambda df: judged(df, thin_chars))


def read_twins(needing: DataFrame, newest: DataFrame, lookup: DataFrame, thin_chars: int = THIN_CHARS) -> DataFrame:
    """``own_articles`` with short texts, all of them, after their AMP twins ``newest`` in ``lookup`` were read; staged.

    The text itself is only kept of rows with ``keep``.
    """

    def derive(df: DataFrame) -> DataFrame:
        return judged(df, thin_chars).withColumn("content", F.when(F.col("keep"), F.col("content")))

    return twin_rows(needing, newest, lookup, "content", derive=derive)


def page_articles(
    pages: DataFrame,
    selector_policy: str | list[str] = "four",
    content_policy: str = "full",
    min_chars: int = MIN_BODY_CHARS,
    thin_chars: int = THIN_CHARS,
    amp_pages: DataFrame | None = None,
) -> DataFrame:
    """One row per page (and selector policy) with a ``reject_reason`` or NULL.

    Failed loads (by ``status``, if there is one) give no row.  The pages are parsed once,
    when this is called, into a staged table without markup.  AMP twins are looked up in
    ``amp_pages``, by default ``pages``.
    """
    own = own_articles(pages, selector_policy, content_policy, min_chars, thin_chars)
    return with_twins(own, pages if amp_pages is None else amp_pages, min_chars, thin_chars).drop("amp_href")


def extract_articles(
    pages: DataFrame,
    selector_policy: str = "four",
    content_policy: str = "full",
    source_policy: str = "host",
    source_value: str | None = None,
    category: Column | None = None,
    profile: str = "default",
    min_chars: int = MIN_BODY_CHARS,
    thin_chars: int = THIN_CHARS,
    amp_pages: DataFrame | None = None,
) -> DataFrame:
    """Article rows of the pages that yield one, in the shape of the store.

    Without feeds the page id is the order and ``category`` defaults to the
    first path segment of the address.
    """
    rows = page_articles(
        pages, selector_policy, content_policy, min_chars, thin_chars, amp_pages
    ).filter(F.col("reject_reason").isNull())
    return as_store_rows(rows, source_policy, source_value, category, profile)


def as_store_rows(
    rows: DataFrame,
    source_policy: str = "host",
    source_value: str | None = None,
    category: Column | None = None,
    profile: str = "default",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Page rows in the shape of the store, with the columns named in ``carry``."""
    if category is None:
        category = first_segment(F.col("norm_url"))
    return rows.select(
        "id_article",
        "title",
        "tags",
        "content",
        "url",
        category.alias("category"),
        source_name(F.col("url"), F.lit(source_policy), F.lit(source_value)).alias("source"),
        "author",
        "image",
        "published_date",
        "content_hash",
        F.lit(profile).alias("profile"),
        F.lit(0).alias("feed_ord"),
        F.col("page_id").alias("entry_ord"),
        "published_ts",
        *carry,
    )
