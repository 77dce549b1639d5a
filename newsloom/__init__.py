"""Article corpora on Spark: extraction, two-key de-duplication, incremental ingest."""

from newsloom.functions.urls import with_normalized_url, with_source_name
from newsloom.operators.amp import amp_body
from newsloom.operators.body import article_body
from newsloom.operators.dedup import dedup_two_key, drop_stored
from newsloom.operators.dom import dom_nodes
from newsloom.operators.jsonld import jsonld_body
from newsloom.operators.main_content import main_content
from newsloom.operators.metadata import with_metadata
from newsloom.operators.paragraphs import clean_paragraphs
from newsloom.operators.report import run_report
from newsloom.plans.articles import extract_articles
from newsloom.plans.ingest import crawl, entry_pages, ingest
from newsloom.sources.feeds import cap_entries, feed_config, feed_entries
from newsloom.sources.keys import rebuild_keys
from newsloom.sources.pages import read_pages
from newsloom.sources.store import (
    append_articles,
    existing_keys,
    export_csv,
    import_csv,
    open_store,
)
from newsloom.streaming.incremental import ingest_stream, settle_waiting, stream_outcomes

__all__ = [
    "amp_body",
    "append_articles",
    "article_body",
    "cap_entries",
    "clean_paragraphs",
    "crawl",
    "dedup_two_key",
    "dom_nodes",
    "drop_stored",
    "entry_pages",
    "existing_keys",
    "export_csv",
    "extract_articles",
    "feed_config",
    "feed_entries",
    "import_csv",
    "ingest",
    "ingest_stream",
    "jsonld_body",
    "main_content",
    "open_store",
    "read_pages",
    "rebuild_keys",
    "run_report",
    "settle_waiting",
    "stream_outcomes",
    "with_metadata",
    "with_normalized_url",
    "with_source_name",
]
