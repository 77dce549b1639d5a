"""Accepting new articles into the store, from extracted rows or from feeds."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.urls import first_segment, normalized_url, with_source_name
from newsloom.operators.dedup import dedup_outcomes, kept_keys, one_of_equals, without_hits
from newsloom.operators.joins import HOT_ROWS, spread_join
from newsloom.operators.membership import likely_members
from newsloom.operators.paragraphs import SELECTORS
from newsloom.plans.articles import page_articles
from newsloom.sources.feeds import linked as linked_entries
from newsloom.sources.feeds import read_entries, read_failures, read_feeds, with_link_outcome
from newsloom.sources.keys import key_rows, stored_among
from newsloom.sources.pages import loaded_pages, newest_per_url
from newsloom.sources.staging import same_rows, stage, stage_counted
from newsloom.sources.store import append_articles, open_store

_SCOPE = ["profile"]


def entry_order(feed_ord: Column, entry_ord: Column) -> Column:
    """Feed and position as one number, so that minima stay in hash aggregates.

    Positions within a feed are 0 or more and below 2**40, and feeds below 2**22;
    anything else raises.  With feed 0, that of rows without feeds, any id will do.
    """
    feed, entry = feed_ord.cast("long"), entry_ord.cast("long")
    fits = feed.between(1, 2**22 - 1) & entry.between(0, 2**40 - 1)
    return (
        F.when((feed == 0) | feed.isNull() | entry.isNull(), F.coalesce(entry + feed, entry))
        .when(fits, F.shiftleft(feed, 40).bitwiseOR(entry))
        .otherwise(F.raise_error(F.lit("a feed's number or an entry's position is out of range")).cast("long"))
    )


def known_keys(keys: DataFrame, path: str) -> DataFrame:
    """Which keys of the staged rows (profile, id, hash) the store has; staged."""
    return stored_among(keys.sparkSession, path, same_rows(key_rows(keys, "id", "hash"), keys))


def accept(keys: DataFrame, hits: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Which of the staged keys (profile, ord, id, hash) are new; staged.

    Stored keys (``hits``) go first: a row the store already has never blocks another one.
    """
    fresh = keys
    for key in ("id", "hash"):
        fresh = without_hits(fresh, hits, key, key, _SCOPE, hot_rows=hot_rows, base=keys)
    return kept_keys(fresh, _SCOPE, hot_rows)


def key_outcomes(
    keys: DataFrame, kept: DataFrame, hits: DataFrame, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Outcome of every key, given the kept ones and the stored ones before the run.

    An id that is stored, or was kept earlier, makes a ``dup_id``.
    """
    new_ids = stage_counted(without_hits(keys, hits, "id", "id", _SCOPE, hot_rows=hot_rows), "new-ids")
    known = keys.join(new_ids.select("profile", "ord"), ["profile", "ord"], "left_anti")
    return dedup_outcomes(new_ids, kept, _SCOPE, hot_rows).unionByName(
        known.withColumn("outcome", F.lit("dup_id"))
    )


def drop_known(
    articles: DataFrame, path: str, by: tuple[str, ...] = ("id_article", "content_hash"), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Staged articles whose keys, those named in ``by``, are new to their profile in the store.

    The store's key index answers for both keys in one scan.
    """
    kinds = {"id_article": "id", "content_hash": "hash"}
    rows = articles if "content_hash" in by else articles.drop("content_hash")
    hits = stored_among(articles.sparkSession, path, same_rows(key_rows(rows), articles))
    fresh = articles
    for key in by:
        fresh = without_hits(fresh, hits, kinds[key], key, _SCOPE, "entry_ord", hot_rows, articles)
    return fresh


def ingest(
    articles: DataFrame, path: str, hot_rows: int = HOT_ROWS, staged: bool = False
) -> DataFrame:
    """Append the articles that are new by both keys; returns the appended rows.

    Keys are decided on narrow columns; bodies are read once more, for the
    accepted rows only.  ``articles`` is written to a staged table first, unless
    it is one already (``staged``), as the result of ``extract_articles`` is.
    """
    staged_rows = articles if staged else stage_counted(articles, "batch")
    rows = staged_rows.withColumn("ord", entry_order(F.col("feed_ord"), F.col("entry_ord")))
    keys = rows.select(
        "profile", "ord", F.col("id_article").alias("id"), F.col("content_hash").alias("hash")
    )
    keys = same_rows(keys, staged_rows)
    open_store(articles.sparkSession, path)
    kept = accept(keys, known_keys(keys, path), hot_rows)
    names = kept.select(
        "profile", "ord", F.col("id").alias("id_article"), F.col("hash").alias("content_hash")
    )
    accepted = one_of_equals(rows, names).drop("ord")
    append_articles(accepted, path)
    return accepted


def entry_pages(entries: DataFrame, pages: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Attach the newest landed page to every entry, by normalised address.

    Adds ``page_id`` and ``reject_reason`` (bad_link, no_page or NULL).  Only
    narrow columns take part; page texts are attached later by ``page_id``.
    ``entries`` should be staged.
    """
    links = entries if "norm_url" in entries.columns else with_link_outcome(entries)
    landed = newest_per_url(
        loaded_pages(pages).drop("html").withColumn("norm_url", normalized_url(F.col("url"))),
        "norm_url",
    )
    spread_by = ["feed_ord", "entry_ord"]
    joined = spread_join(links, landed, ["norm_url"], "left", spread_by, hot_rows=hot_rows)
    reason = F.coalesce("reject_reason", F.when(F.col("page_id").isNull(), "no_page"))
    return joined.withColumn("reject_reason", reason)


class Run(NamedTuple):
    """Result of a feed run: accepted store rows, and one outcome per entry and per failed feed."""

    accepted: DataFrame
    outcomes: DataFrame


def crawl(
    feed_docs: DataFrame,
    feeds: DataFrame,
    pages: DataFrame,
    store_path: str,
    content_policy: str = "full",
    hot_rows: int = HOT_ROWS,
) -> Run:
    """A full run: feed documents and landed pages into the store."""
    pages = loaded_pages(pages)
    read = stage(read_feeds(feed_docs, feeds), "feeds")
    entries = stage_counted(with_link_outcome(linked_entries(read_entries(read))), "entries")
    linked = stage_counted(entry_pages(entries, pages, hot_rows), "linked")
    wanted = stage_counted(
        linked.filter(F.col("page_id").isNotNull()).select("page_id").distinct(), "wanted"
    )
    in_use = [p for p in SELECTORS if not feeds.filter(F.col("selector_policy") == p).isEmpty()]
    articles = page_articles(
        likely_members(pages, wanted, "page_id"), in_use or list(SELECTORS), content_policy, amp_pages=pages
    )
    at = ["page_id", "selector_policy"]
    verdicts = articles.select(
        *at,
        F.col("id_article").alias("id"),
        F.col("content_hash").alias("hash"),
        F.col("reject_reason").alias("page_reason"),
    )
    seen = stage_counted(
        spread_join(linked, verdicts, at, "left", ["feed_ord", "entry_ord"], hot_rows=hot_rows)
        .withColumn("reject_reason", F.coalesce("reject_reason", "page_reason"))
        .withColumn("ord", entry_order(F.col("feed_ord"), F.col("entry_ord"))),
        "seen",
    )
    keys = seen.filter(F.col("reject_reason").isNull()).select("profile", "ord", "id", "hash")
    open_store(pages.sparkSession, store_path)
    hits = known_keys(keys, store_path)
    kept = accept(keys, hits, hot_rows)
    named = stage_counted(key_outcomes(keys, kept, hits, hot_rows).select("profile", "ord", "outcome"), "named")
    won = seen.join(kept.select("profile", "ord"), ["profile", "ord"], "left_semi").select(
        "profile", "feed_ord", "entry_ord", "category", "source_policy", "source_value", *at
    )
    # An accepted id is unique within its profile, so no page is a hot key here.
    accepted = stage_counted(with_source_name(won.join(articles, at)), "accepted-rows")
    append_articles(accepted, store_path)
    outcomes = seen.join(named, ["profile", "ord"], "left").select(
        "profile",
        "feed_ord",
        "entry_ord",
        "category",
        "link",
        F.coalesce("reject_reason", "outcome").alias("outcome"),
    )
    failed = read_failures(read).select(
        "profile",
        "feed_ord",
        F.lit(None).cast("long").alias("entry_ord"),
        "category",
        F.lit(None).cast("string").alias("link"),
        "outcome",
    )
    return Run(accepted, outcomes.unionByName(failed))


def page_outcomes(rows: DataFrame, profile: str = "default", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Outcome of every extracted page (a staged ``page_articles`` table).

    Without feeds the page id is the order and the first path segment of the
    address is the category.
    """
    named = rows.select(
        F.lit(profile).alias("profile"),
        first_segment(F.col("norm_url")).alias("category"),
        F.col("page_id").alias("ord"),
        F.col("id_article").alias("id"),
        F.col("content_hash").alias("hash"),
        "reject_reason",
    )
    good = named.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    kept = kept_keys(good, _SCOPE, hot_rows)
    columns = ["profile", "category", "ord", "outcome"]
    decided = dedup_outcomes(good, kept, _SCOPE, hot_rows).select(*columns)
    refused = named.filter(F.col("reject_reason").isNotNull())
    return decided.unionByName(refused.withColumnRenamed("reject_reason", "outcome").select(*columns))
