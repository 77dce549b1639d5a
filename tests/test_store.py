import pytest
from pyspark.sql import functions as F

from newsloom import (
    append_articles, crawl, existing_keys, export_csv, extract_articles, import_csv, ingest,
    ingest_stream, open_store, run_report,
)
from newsloom.plans.ingest import entry_order
from newsloom.schemas import ARTICLE_COLUMNS, FEED_SCHEMA, STORE_SCHEMA
from newsloom.sources.staging import stage, staging_root


def articles(spark, *rows):
    """(profile, entry_ord, id, hash) -> article rows."""
    df = spark.createDataFrame(
        list(rows), "profile string, entry_ord bigint, id_article string, content_hash string"
    )
    for field in STORE_SCHEMA.fields:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    return df.withColumn("feed_ord", F.lit(0))


def stored(spark, path):
    return sorted((r.profile, r.entry_ord) for r in open_store(spark, path).collect())


def test_a_missing_store_is_created_empty_and_kept(spark, tmp_path):
    path = str(tmp_path / "store")
    assert open_store(spark, path).schema == STORE_SCHEMA
    append_articles(articles(spark, ("p", 1, "000000000012", "x")), path)
    again = open_store(spark, path)
    assert [tuple(r) for r in existing_keys(again).collect()] == [("p", "000000000012", "x")]
    legacy = existing_keys(again.drop("content_hash"))
    assert [tuple(r) for r in legacy.collect()] == [("p", "000000000012", None)]


def test_an_unreadable_store_raises(spark, tmp_path):
    folder = tmp_path / "store" / "profile=p"
    folder.mkdir(parents=True)
    (folder / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        existing_keys(open_store(spark, str(tmp_path / "store"))).collect()


def test_ingest_is_scoped_and_repeatable(spark, tmp_path):
    path = str(tmp_path / "store")
    first = articles(spark, ("p", 1, "a", "x"), ("p", 2, "a", "y"), ("p", 3, "b", "y"), ("q", 1, "a", "x"))
    assert ingest(first, path).count() == 3
    assert stored(spark, path) == [("p", 1), ("p", 3), ("q", 1)]
    assert ingest(first, path).count() == 0
    # Stored keys reject first, so row 4 does not block row 5.
    second = articles(spark, ("p", 4, "a", "n"), ("p", 5, "c", "n"), ("p", 6, "d", "x"))
    assert ingest(second, path, hot_rows=1).count() == 1
    assert stored(spark, path) == [("p", 1), ("p", 3), ("p", 5), ("q", 1)]


def test_entry_order_sorts_by_feed_then_position(spark):
    pairs = [(0, 0), (0, 2**40 - 1), (1, 0), (1, 59), (2**20, 3)]
    df = spark.createDataFrame(pairs, "f int, e bigint").select(entry_order(F.col("f"), F.col("e")))
    got = [r[0] for r in df.collect()]
    assert got == sorted(got) and len(set(got)) == len(got)
    for pair in ((1, 2**40), (1, -1), (2**22, 0), (-1, 5)):
        bad = spark.createDataFrame([pair], "f int, e bigint").select(entry_order(F.col("f"), F.col("e")))
        with pytest.raises(Exception, match="out of range"):
            bad.collect()
    # Rows without feeds may have any id.
    free = spark.createDataFrame([(0, -7), (0, 2**50)], "f int, e bigint")
    assert [r[0] for r in free.select(entry_order(F.col("f"), F.col("e"))).collect()] == [-7, 2**50]


def test_csv_roundtrip(spark, tmp_path):
    odd = ['say "hi", x', "p1\n\np2", "back\\", "é", " lead and trail ", "a,b", '"', "x\r\ny"]
    rows = [(f"{i:012d}", text, None, "") for i, text in enumerate(odd)]
    df = spark.createDataFrame(rows, "id_article string, content string, tags string, author string")
    for name in ARTICLE_COLUMNS:
        if name not in df.columns:
            df = df.withColumn(name, F.lit("v"))
    export_csv(df, str(tmp_path / "csv"))
    back = import_csv(spark, str(tmp_path / "csv")).orderBy("id_article").collect()
    assert list(back[0].asDict()) == list(ARTICLE_COLUMNS)
    assert [(r.id_article, r.content) for r in back] == [(r[0], r[1]) for r in rows]
    assert {(r.tags, r.author) for r in back} == {(None, None)}


def html(text, category=""):
    return f"<article><h1>T{category}</h1><p>{text * 60}</p></article>"


def test_crawl(spark, tmp_path):
    feeds = spark.createDataFrame(
        [
            ("p", 0, "first", "f0", 60, "constant", "Wire", "four"),
            ("p", 1, "second", "f1", 60, "constant", "Wire", "four"),
            ("q", 0, "other", "f2", 60, "first_label", None, "three"),
        ],
        FEED_SCHEMA,
    )

    def rss(*links):
        return "<rss><channel>" + "".join(f"<item><link>{x}</link></item>" for x in links) + "</channel></rss>"

    docs = spark.createDataFrame(
        [
            ("f0", rss("http://W.com/a/", "http://w.com/thin", "http://[bad")),
            ("f1", rss("http://w.com/a?utm_source=x", "http://w.com/copy", "http://w.com/none")),
            ("f2", rss("http://w.com/a", "http://w.com/bare")),
        ],
        "feed_url string, xml string",
    )
    pages = spark.createDataFrame(
        [
            (1, "http://w.com/a", html("same text ")),
            (2, "http://w.com/copy", html("same text ")),
            (3, "http://w.com/thin", "<p>x</p>"),
            (4, "http://w.com/bare", "<div><p>" + "bare text " * 60 + "</p></div>"),
        ],
        "page_id bigint, url string, html string",
    )
    store = str(tmp_path / "store")
    run = crawl(docs, feeds, pages, store, content_policy="selectors")
    outcomes = {(r.profile, r.link): r.outcome for r in run.outcomes.collect()}
    assert outcomes == {
        ("p", "http://W.com/a/"): "accepted",
        ("p", "http://w.com/thin"): "thin",
        ("p", "http://[bad"): "bad_link",
        ("p", "http://w.com/a?utm_source=x"): "dup_id",
        ("p", "http://w.com/copy"): "dup_hash",
        ("p", "http://w.com/none"): "no_page",
        ("q", "http://w.com/a"): "accepted",
        ("q", "http://w.com/bare"): "accepted",
    }
    got = {(r.profile, r.url): (r.category, r.source) for r in open_store(spark, store).collect()}
    assert got == {
        ("p", "http://w.com/a"): ("first", "Wire"),
        ("q", "http://w.com/a"): ("other", "W"),
        ("q", "http://w.com/bare"): ("other", "W"),
    }
    again = crawl(docs, feeds, pages, store, content_policy="selectors")
    assert again.accepted.count() == 0
    report = {tuple(r)[:3]: r.n for r in run_report(again.outcomes).collect()}
    assert report == {
        ("p", "first", "bad_link"): 1,
        ("p", "first", "dup_id"): 1,
        ("p", "first", "thin"): 1,
        ("p", "second", "dup_id"): 1,
        ("p", "second", "dup_hash"): 1,
        ("p", "second", "no_page"): 1,
        ("q", "other", "dup_id"): 2,
    }


def test_streamed_batches_equal_one_batch_and_replays_add_nothing(spark, tmp_path):
    rows = [
        (1, "https://w.com/en/1", html("one ")),
        (2, "https://w.com/en/2", html("one ")),
        (3, "https://w.com/de/3", html("three ")),
        (4, "https://w.com/de/3/", html("four ")),
        (5, "https://w.com/en/2", html("five ")),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1)
    whole, store = str(tmp_path / "whole"), str(tmp_path / "store")
    ingest(extract_articles(pages, content_policy="selectors"), whole)

    landing = str(tmp_path / "landing")

    def run(checkpoint):
        ingest_stream(
            spark, landing, store, str(tmp_path / checkpoint), max_files_per_trigger=1,
            content_policy="selectors",
        ).awaitTermination()

    pages.filter("page_id <= 2").write.mode("append").parquet(landing)
    run("c1")
    pages.filter("page_id > 2").write.mode("append").parquet(landing)
    run("c1")
    assert stored(spark, store) == stored(spark, whole) == [("default", 1), ("default", 3), ("default", 5)]
    # A lost checkpoint replays everything.
    run("c2")
    assert stored(spark, store) == stored(spark, whole)


def test_staging_uses_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert staging_root(spark) == root
    staged = stage(spark.range(3), "x")
    assert all(f.startswith(f"file://{root}/newsloom-x-") for f in staged.inputFiles())
