"""Body text from the AMP twin of a page."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.dom import dom_nodes
from newsloom.operators.joins import HOT_ROWS, spread_join
from newsloom.operators.membership import likely_members
from newsloom.operators.paragraphs import clean_paragraphs
from newsloom.schemas import MIN_BODY_CHARS
from newsloom.sources.pages import loaded_pages, newest_per_url
from newsloom.sources.staging import row_count, same_rows, stage_counted


def newest_twins(targets: DataFrame, pages: DataFrame) -> DataFrame:
    """The newest loaded page at each of the addresses ``targets.amp_href``; staged, as ``amp_href, twin_id``.

    Addresses are compared as they are, without normalisation.
    """
    at = loaded_pages(pages).withColumnRenamed("url", "amp_href")
    narrow = at.drop("html").join(targets, "amp_href", "left_semi")
    return stage_counted(newest_per_url(narrow, "amp_href").withColumnRenamed("page_id", "twin_id"), "amp-pages")


def amp_texts(newest: DataFrame, pages: DataFrame) -> DataFrame:
    """Cleaned paragraphs of the loaded pages named by ``newest`` (staged), and of few others.

    Markup is parsed where it is read: a filter in the scan finds the pages, and what it
    lets through by chance has no ``amp_href, twin_id`` of ``newest``.
    """
    at = loaded_pages(pages).withColumnsRenamed({"url": "amp_href", "page_id": "twin_id"})
    found = likely_members(at.select("amp_href", "twin_id", "html"), newest, "twin_id")
    return clean_paragraphs(dom_nodes(found), "three", "twin_text").select("amp_href", "twin_id", "twin_text")


def twin_rows(
    needing: DataFrame,
    newest: DataFrame,
    pages: DataFrame,
    text_col: str,
    id_col: str = "page_id",
    hot_rows: int = HOT_ROWS,
    derive: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """All rows of ``needing``, with a strictly longer text of the AMP twin where there is one; staged.

    ``newest`` (staged) names the twins as ``newest_twins`` does.  Their texts are shuffled
    once, when they meet their rows.
    """
    texts = amp_texts(newest, pages)
    named = same_rows(spread_join(needing, newest, ["amp_href"], "left", [id_col], hot_rows=hot_rows), needing)
    joined = spread_join(named, texts, ["amp_href", "twin_id"], "left", [id_col], hot_rows=hot_rows)
    longer = F.when(
        F.length("twin_text") > F.length(text_col), F.col("twin_text")
    ).otherwise(F.col(text_col))
    return stage_counted(derive(joined.withColumn(text_col, longer)).select(*needing.columns), "amp-rows")


def with_amp_body(
    rows: DataFrame,
    pages: DataFrame,
    text_col: str,
    id_col: str = "page_id",
    min_chars: int = MIN_BODY_CHARS,
    hot_rows: int = HOT_ROWS,
    derive: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Replace short texts by a strictly longer text of the AMP twin.

    ``rows`` (staged) are split: only rows with a short text and an AMP link
    take part in the join, and these are narrow by definition.  ``derive``
    renews columns that depend on the text.  The result is staged as well.
    """
    short = (F.length(text_col) < min_chars) & F.col("amp_href").isNotNull()
    needing = rows.filter(short)
    needing.staged_rows = row_count(needing)
    if not needing.staged_rows:
        return rows
    newest = newest_twins(needing.select("amp_href").distinct(), pages)
    replaced = twin_rows(needing, newest, pages, text_col, id_col, hot_rows, derive)
    return rows.filter(~short).unionByName(replaced)


def amp_body(nodes_df: DataFrame, pages: DataFrame, text_col: str | None = None) -> DataFrame:
    """Add ``amp_text``: the AMP stage on its own, or on top of ``text_col``."""
    text = F.lit("") if text_col is None else F.col(text_col)
    rows = nodes_df.drop("nodes").withColumn("amp_text", text)
    return with_amp_body(stage_counted(rows, "amp"), pages, "amp_text")
