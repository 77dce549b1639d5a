"""Every operator as a registered query over the given tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.catalog import render
from newsloom.functions.text import article_id, content_hash
from newsloom.functions.urls import normalized_url, with_normalized_url, with_source_name
from newsloom.operators.amp import amp_body as amp_body_of
from newsloom.operators.body import article_body as article_body_of
from newsloom.operators.dedup import dedup_two_key
from newsloom.operators.dom import dom_nodes as dom_nodes_of
from newsloom.operators.jsonld import jsonld_body as jsonld_body_of
from newsloom.operators.main_content import main_content as main_content_of
from newsloom.operators.metadata import with_metadata
from newsloom.operators.paragraphs import clean_paragraphs as clean_paragraphs_of
from newsloom.operators.paragraphs import with_paragraphs
from newsloom.operators.report import run_report as report_of
from newsloom.plans.articles import extract_articles, page_articles
from newsloom.plans.ingest import crawl, drop_known, ingest, page_outcomes
from newsloom.plans.ingest import entry_pages as entry_pages_of
from newsloom.schemas import ARTICLE_COLUMNS
from newsloom.sources import feeds as feed_source
from newsloom.sources.pages import loaded_pages
from newsloom.sources.staging import stage, staging_path
from newsloom.sources.store import (
    append_articles,
    export_csv,
    import_csv,
    open_store,
)
from newsloom.sources.store import existing_keys as existing_keys_of
from newsloom.streaming.incremental import ingest_stream, settle_waiting
from newsloom.streaming.incremental import stream_outcomes as stream_outcomes_of

Query = Callable[[SparkSession, str], DataFrame]


# --- over the pages table -------------------------------------------------


def normalize_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_normalized_url(render.pages(spark, sf_dir)).select("page_id", "norm_url")


def source_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every policy for every page."""
    named = with_normalized_url(render.pages(spark, sf_dir)).select(
        "page_id",
        "norm_url",
        F.explode(F.array(F.lit("constant"), F.lit("host"), F.lit("first_label"))).alias(
            "source_policy"
        ),
        F.lit("Wire").alias("source_value"),
    )
    return with_source_name(named, "norm_url").select("page_id", "source_policy", "source")


def article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.pages(spark, sf_dir).select(
        "page_id", article_id(normalized_url(F.col("url"))).alias("id_article")
    )


def _with_status(pages: DataFrame) -> DataFrame:
    """Pages with a load status taken from their address."""
    status = (
        F.when(F.col("url").contains("utm_source"), 404)
        .when(F.col("url").contains("?page="), 301)
        .when(F.col("url").endswith("/"), 500)
    )
    return pages.withColumn("status", status)


def pages_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _with_status(render.pages(spark, sf_dir).select("page_id", "url"))
    return loaded_pages(landed).select("page_id", "url")


def articles_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of the pages that loaded, the status being left to the extraction."""
    landed = _with_status(render.pages(spark, sf_dir))
    return extract_articles(landed, content_policy="selectors").select(
        "entry_ord", "id_article", "content_hash"
    )


def _page_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dom_nodes_of(render.pages(spark, sf_dir))


def dom_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(tag: str):
        return F.size(F.filter("nodes", lambda n: n["tag"] == tag)).cast("long")

    return _page_nodes(spark, sf_dir).select(
        "page_id",
        count("h1").alias("n_h1"),
        count("p").alias("n_p"),
        count("a").alias("n_a"),
        count("li").alias("n_li"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_metadata(_page_nodes(spark, sf_dir)).select("page_id", "title")


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected paragraphs before cleaning, with their position."""
    selected = with_paragraphs(_page_nodes(spark, sf_dir), "four")
    return selected.select("page_id", F.posexplode("paragraphs").alias("pos", "p")).select(
        "page_id", F.col("pos").cast("long").alias("pos"), F.col("p")["text"].alias("text")
    )


def clean_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_paragraphs_of(_page_nodes(spark, sf_dir), "three", "content").select(
        "page_id", "content"
    )


def _page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_articles(render.pages(spark, sf_dir), content_policy="selectors")


def not_thin(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _page_rows(spark, sf_dir).filter(F.col("reject_reason").isNull())
    return kept.select("page_id", F.length("content").cast("long").alias("n_chars"))


def content_hash_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_rows(spark, sf_dir).select("page_id", "content_hash")


def _page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_articles(
        render.pages(spark, sf_dir), content_policy="selectors", source_policy="host"
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: pages to de-duplicated article rows."""
    found = _page_articles(spark, sf_dir)
    return dedup_two_key(found, "entry_ord").select(*ARTICLE_COLUMNS)


def dedup_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _page_articles(spark, sf_dir)
    return dedup_two_key(found, "entry_ord").select("entry_ord", "id_article", "content_hash")


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_of(page_outcomes(_page_rows(spark, sf_dir)))


def main_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_content_of(_page_nodes(spark, sf_dir)).select("page_id", "main_text")


def main_content_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles that are split over neighbouring sections."""
    pages = render.render_split(render.documents(spark, sf_dir))
    return main_content_of(dom_nodes_of(pages)).select("page_id", "main_text")


def articles_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship with the main-block stage first."""
    found = extract_articles(render.pages(spark, sf_dir), source_policy="first_label")
    return dedup_two_key(found, "entry_ord").select(*ARTICLE_COLUMNS)


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a landing folder that grows between them, then a third."""
    landing = staging_path(spark, "landing")
    store = staging_path(spark, "store")
    progress = staging_path(spark, "progress")
    pages = render.pages(spark, sf_dir)
    secure = F.col("url").startswith("https:")

    def run() -> None:
        ingest_stream(
            spark, landing, store, progress, content_policy="selectors"
        ).awaitTermination()

    for part in (pages.filter(secure), pages.filter(~secure)):
        part.write.mode("append").parquet(landing)
        run()
    run()
    return open_store(spark, store).select("entry_ord", "id_article", "content_hash", "category")


def stream_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of two streamed batches in page order, which is that of one batch."""
    landing, store, progress = (staging_path(spark, label) for label in ("landing", "store", "progress"))
    pages = render.pages(spark, sf_dir)
    middle = pages.agg(F.avg("page_id")).first()[0]
    early = F.col("page_id") < F.lit(middle)
    for part in (pages.filter(early), pages.filter(~early)):
        part.write.mode("append").parquet(landing)
        ingest_stream(spark, landing, store, progress, content_policy="selectors").awaitTermination()
    return report_of(stream_outcomes_of(spark, store))


# --- rendered out of the documents table ------------------------------------


def normalize_url_encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as query values, next to keys that go, repeat or are blank."""
    url = F.concat(
        F.lit("HTTP://User@X.Example.com:80/"), F.col("lang"), F.lit("//?b=1&utm_medium=m&text="),
        F.url_encode("text"), F.lit("&&blank&b="), F.col("source"), F.lit("#f?x=1"),
    )
    return render.documents(spark, sf_dir).select("doc_id", normalized_url(url).alias("norm_url"))


def content_hash_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render.documents(spark, sf_dir).select(
        "doc_id", content_hash(F.col("lang"), F.col("text")).alias("content_hash")
    )


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = render.documents(spark, sf_dir)
    found = feed_source.feed_entries(render.render_feeds(docs), render.render_feed_config(docs))
    return found.select("profile", "feed_ord", "entry_ord", "category", "link")


def configured_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an entry of one configured feed of each profile, with category and source."""
    feeds = feed_source.feed_config(spark)
    sizes = feeds.groupBy("profile").agg(F.count("*").alias("n"))
    entries = render.documents(spark, sf_dir).select(
        "doc_id", normalized_url(F.concat(F.lit("http://WWW.Site"), F.col("source"), F.lit(".example/a"))).alias("norm_url")
    )
    numbered = feeds.join(sizes, "profile")
    placed = entries.join(F.broadcast(numbered), F.col("doc_id") % F.col("n") == F.col("feed_ord"))
    return with_source_name(placed, "norm_url").select("doc_id", "profile", "feed_ord", "category", "feed_url", "source")


def feed_landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every feed landed twice, first with half of its entries; the newest landing counts."""
    docs = render.documents(spark, sf_dir)
    half = render.render_feeds(docs.filter("doc_id % 2 = 0")).withColumn("fetched_at", F.lit(1))
    whole = render.render_feeds(docs).withColumn("fetched_at", F.lit(2))
    found = feed_source.feed_entries(half.unionByName(whole), render.render_feed_config(docs))
    return found.select("profile", "feed_ord", "entry_ord", "category", "link")


def entries_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions that survive the cut, with or without a link."""
    docs = render.documents(spark, sf_dir)
    found = feed_source.all_feed_entries(
        render.render_feeds(docs), render.render_feed_config(docs), cap=25
    )
    return found.select("profile", "feed_ord", "entry_ord", "link")


def _entry_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries as a table, one per document; the language is the feed."""
    return render.documents(spark, sf_dir).select(
        F.col("lang").alias("profile"),
        F.lit(0).alias("feed_ord"),
        F.col("doc_id").alias("entry_ord"),
        F.col("source").alias("category"),
        render.entry_link().alias("link"),
    )


def entries_capped_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    capped = feed_source.cap_entries(_entry_table(spark, sf_dir), 60)
    return capped.select("profile", "entry_ord", "link")


def entries_linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_source.linked(_entry_table(spark, sf_dir)).select("entry_ord", "link")


def entry_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = stage(feed_source.linked(_entry_table(spark, sf_dir)), "entries")
    landed = render.render_landed(render.documents(spark, sf_dir))
    return entry_pages_of(entries, landed).select(
        "entry_ord", "norm_url", "page_id", "reject_reason"
    )


def _head_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_metadata(dom_nodes_of(render.render_heads(render.documents(spark, sf_dir))))


def canonical_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _head_meta(spark, sf_dir).select("page_id", "url", "norm_url", "id_article")


def meta_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _head_meta(spark, sf_dir).select("page_id", "title", "author", "image")


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _head_meta(spark, sf_dir).select("page_id", "tags")


def published_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _head_meta(spark, sf_dir).select(
        "page_id", "published_date", F.unix_micros("published_ts").alias("published_us")
    )


def _body_meta(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    landed = render.render_bodies(render.documents(spark, sf_dir))
    return with_metadata(dom_nodes_of(landed)), landed


def jsonld_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta, _ = _body_meta(spark, sf_dir)
    return jsonld_body_of(meta).select("page_id", "jsonld_text")


def amp_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta, landed = _body_meta(spark, sf_dir)
    return amp_body_of(meta, landed).select("page_id", "amp_text")


def article_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta, landed = _body_meta(spark, sf_dir)
    return article_body_of(meta, landed, "selectors", "three").select("page_id", "body")


def _half_stored(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A store that has some sources already, and the articles of the rest."""
    rows = render.document_articles(render.documents(spark, sf_dir))
    stored = F.col("source") < "src15"
    path = staging_path(spark, "store")
    append_articles(rows.filter(stored), path)
    return path, rows.filter(~stored)


def existing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _half_stored(spark, sf_dir)
    return existing_keys_of(open_store(spark, path)).select("id_article", "content_hash")


def new_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, arriving = _half_stored(spark, sf_dir)
    return drop_known(stage(arriving, "arrived"), path, ("id_article",)).select("entry_ord", "id_article")


def new_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, arriving = _half_stored(spark, sf_dir)
    return drop_known(stage(arriving, "arrived"), path).select("entry_ord", "id_article", "content_hash")


def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = render.document_articles(render.documents(spark, sf_dir), F.col("lang"))
    path = staging_path(spark, "store")
    open_store(spark, path)
    early = F.col("source") < "src15"
    append_articles(rows.filter(early), path)
    append_articles(rows.filter(~early), path)
    return open_store(spark, path).select(
        *ARTICLE_COLUMNS, "profile", "feed_ord", "entry_ord",
        F.unix_micros("published_ts").alias("published_us"),
    )


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = render.document_articles(render.documents(spark, sf_dir))
    path = staging_path(spark, "csv")
    export_csv(rows, path)
    return import_csv(spark, path)


def ingest_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches and a repeat of the second one; de-duplicated per profile."""
    profile = F.when(F.col("lang") == "en", "en").otherwise("other")
    rows = render.document_articles(render.documents(spark, sf_dir), profile)
    path = staging_path(spark, "store")
    early = F.col("source") < "src15"
    for batch in (rows.filter(early), rows.filter(~early), rows.filter(~early)):
        ingest(batch, path)
    return open_store(spark, path).select("profile", "entry_ord", "id_article", "content_hash")


def dedup_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row twice, and neighbouring rows at one position."""
    rows = render.document_articles(render.documents(spark, sf_dir)).withColumn(
        "entry_ord", F.floor(F.col("entry_ord") / 2)
    )
    kept = dedup_two_key(rows.unionByName(rows), "entry_ord")
    return kept.select("entry_ord", "id_article", "content_hash")


def dedup_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = render.document_articles(render.documents(spark, sf_dir), F.col("source"))
    kept = dedup_two_key(rows, ["feed_ord", "entry_ord"], scope=["profile"])
    return kept.select("profile", "entry_ord", "id_article", "content_hash")


def _crawl(spark: SparkSession, sf_dir: str):
    docs = render.documents(spark, sf_dir)
    return crawl(
        render.render_feeds(docs),
        render.render_feed_config(docs),
        render.render_landed(docs),
        staging_path(spark, "store"),
        content_policy="selectors",
    )


def crawl_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run: feeds and landed pages to stored rows of three profiles."""
    return _crawl(spark, sf_dir).accepted.select(
        *ARTICLE_COLUMNS, "profile", "feed_ord", "entry_ord"
    )


def crawl_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_of(_crawl(spark, sf_dir).outcomes)


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every entry that was not accepted, and why."""
    outcomes = _crawl(spark, sf_dir).outcomes
    return outcomes.filter(F.col("outcome") != "accepted").select(
        "profile", "feed_ord", "entry_ord", "outcome"
    )


def late_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and AMP twins that land in either order; a replay of everything adds nothing."""
    landing, store = staging_path(spark, "landing"), staging_path(spark, "store")
    pages = render.render_twins(render.documents(spark, sf_dir))
    options = {"content_policy": "selectors"}
    first, again = staging_path(spark, "progress"), staging_path(spark, "progress")
    for part in (1, 2):
        pages.filter(F.col("part") == part).drop("part").write.mode("append").option("compression", "zstd").parquet(landing)
        ingest_stream(spark, landing, store, first, **options).awaitTermination()
    settle_waiting(spark, store, **options)
    ingest_stream(spark, landing, store, again, **options).awaitTermination()
    settle_waiting(spark, store, **options)
    return open_store(spark, store).select("entry_ord", "id_article", "content_hash", "title")


QUERIES: dict[str, Query] = {
    "articles": articles,
    "normalize_url": normalize_url,
    "normalize_url_encoded": normalize_url_encoded,
    "source_name": source_name,
    "article_ids": article_ids,
    "content_hash": content_hash_pages,
    "content_hash_documents": content_hash_documents,
    "pages_ok": pages_ok,
    "articles_loaded": articles_loaded,
    "dom_nodes": dom_nodes,
    "titles": titles,
    "paragraphs": paragraphs,
    "clean_paragraphs": clean_paragraphs,
    "not_thin": not_thin,
    "dedup_articles": dedup_articles,
    "dedup_profiles": dedup_profiles,
    "dedup_repeated": dedup_repeated,
    "run_report": run_report,
    "main_content": main_content,
    "articles_full": articles_full,
    "main_content_split": main_content_split,
    "configured_sources": configured_sources,
    "feed_entries": feed_entries,
    "feed_landings": feed_landings,
    "entries_capped": entries_capped,
    "entries_capped_table": entries_capped_table,
    "entries_linked": entries_linked,
    "entry_pages": entry_pages,
    "canonical_url": canonical_url,
    "meta_fields": meta_fields,
    "tags": tags,
    "published_date": published_date,
    "jsonld_body": jsonld_body,
    "amp_body": amp_body,
    "article_body": article_body,
    "existing_keys": existing_keys,
    "new_by_id": new_by_id,
    "new_by_hash": new_by_hash,
    "append_roundtrip": append_roundtrip,
    "csv_roundtrip": csv_roundtrip,
    "ingest_twice": ingest_twice,
    "incremental_ingest": incremental_ingest,
    "stream_report": stream_report,
    "late_twins": late_twins,
    "crawl_articles": crawl_articles,
    "crawl_report": crawl_report,
    "rejects": rejects,
}
