from pyspark.sql import functions as F

from newsloom import cap_entries, entry_pages, feed_config, feed_entries
from newsloom.schemas import FEED_SCHEMA
from newsloom.sources.feeds import all_feed_entries, failed_feeds, with_link_outcome
from newsloom.sources.pages import newest_per_url, read_pages
from newsloom.sources.staging import stage


def rss(*items):
    return f"<rss version='2.0'><channel><title>t</title><link>http://home</link>{''.join(items)}</channel></rss>"


def item(link):
    return "<item><title>t</title></item>" if link is None else f"<item><link>{link}</link></item>"


def feeds(spark, *urls, cap=None):
    rows = [("p", i, f"c{i}", u, cap, "host", None, "four") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, FEED_SCHEMA)


def test_configuration(spark):
    table = feed_config(spark)
    counts = {r.profile: r["count"] for r in table.groupBy("profile").count().collect()}
    assert sorted(counts.values()) == [1, 8, 10, 10, 10, 12]
    assert table.select("profile", "feed_ord").distinct().count() == table.count() == 51
    assert table.filter("selector_policy = 'three' AND source_policy = 'first_label'").count() == 10


def test_positions_cap_and_missing_links(spark):
    docs = spark.createDataFrame(
        [
            ("u0", rss(*[item(f"http://x/{i}") for i in range(61)])),
            ("u1", rss(item("http://x/a"), item(None), item(""), item("http://x/b"), item("http://x/c"))),
            ("u2", "<rss><channel><item><link>http://x/z"),
            ("u3", "not xml"),
            ("unconfigured", rss(item("http://x/q"))),
        ],
        "feed_url string, xml string",
    )
    table = feeds(spark, "u0", "u1", "u2", "u3", "u4")
    entries = feed_entries(docs, table).orderBy("feed_ord", "entry_ord").collect()
    assert [e.link for e in entries if e.feed_ord == 0] == [f"http://x/{i}" for i in range(61)]
    capped = feed_entries(docs, feeds(spark, "u0", cap=60))
    assert sorted(e.entry_ord for e in capped.collect()) == list(range(60))
    assert [(e.entry_ord, e.link) for e in entries if e.feed_ord == 1] == [
        (0, "http://x/a"), (3, "http://x/b"), (4, "http://x/c"),
    ]
    assert {e.feed_ord for e in entries} == {0, 1}
    assert [e.entry_ord for e in feed_entries(docs, table, cap=4).filter("feed_ord = 1").collect()] == [0, 3]
    assert all_feed_entries(docs, table).filter("feed_ord = 1").count() == 5
    failed = {r.feed_ord: r.outcome for r in failed_feeds(docs, table).collect()}
    assert failed == {2: "bad_feed", 3: "bad_feed", 4: "no_feed"}


def test_newest_landing_counts(spark):
    docs = spark.createDataFrame(
        [("u0", rss(item("http://x/a"), item("http://x/b")), 1), ("u0", rss(item("http://x/c"), item("http://x/a")), 2)],
        "feed_url string, xml string, fetched_at int",
    )
    got = feed_entries(docs, feeds(spark, "u0")).orderBy("entry_ord").collect()
    assert [(e.entry_ord, e.link) for e in got] == [(0, "http://x/c"), (1, "http://x/a")]
    assert [e.link for e in feed_entries(docs.drop("fetched_at"), feeds(spark, "u0")).orderBy("entry_ord").collect()] == [
        "http://x/c", "http://x/a",
    ]


def test_salvage_and_permalinks(spark):
    broken = "<rss><channel><item><title>a &nope; b</title><link>http://x/0</link></item>" + item("http://x/1") + "<item><link>http://x/2"
    guids = rss(
        "<item><guid>http://x/g</guid></item>", '<item><guid isPermaLink="false">id</guid></item>',
        '<item><guid isPermaLink="true">http://x/h</guid><link>http://x/l</link></item>',
    )
    docs = spark.createDataFrame([("u0", broken), ("u1", guids), ("u2", rss())], "feed_url string, xml string")
    table = feeds(spark, "u0", "u1", "u2")
    got = feed_entries(docs, table).orderBy("feed_ord", "entry_ord").collect()
    assert [(e.feed_ord, e.link) for e in got if e.link != "http://x/0"] == [
        (0, "http://x/1"), (1, "http://x/g"), (1, "http://x/l"),
    ]
    # A feed that can be read and is empty has not failed.
    assert failed_feeds(docs, table).count() == 0


def test_atom_and_rdf(spark):
    atom = (
        '<feed xmlns="http://www.w3.org/2005/Atom"><link href="http://home"/>'
        '<entry><link rel="self" href="http://s"/><link rel="alternate" href="http://x/1"/></entry>'
        '<entry><link href="http://x/2"/></entry><entry><id>3</id></entry></feed>'
    )
    rdf = "<rdf><channel><title>t</title></channel><item><link>http://x/3</link></item></rdf>"
    docs = spark.createDataFrame([("u0", atom), ("u1", rdf)], "feed_url string, xml string")
    got = feed_entries(docs, feeds(spark, "u0", "u1")).orderBy("feed_ord", "entry_ord").collect()
    assert [e.link for e in got] == ["http://x/1", "http://x/2", "http://x/3"]


def test_cap_of_an_exploded_table(spark):
    entries = spark.range(1000).select(
        F.lit("p").alias("profile"),
        F.when(F.col("id") < 900, 0).otherwise(1).alias("feed_ord"),
        F.col("id").alias("entry_ord"),
    )
    capped = cap_entries(entries, 60)
    got = sorted((r.feed_ord, r.entry_ord) for r in capped.collect())
    assert got == [(0, i) for i in range(60)] + [(1, i) for i in range(900, 960)]
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_entries_and_pages(spark):
    links = ["http://X/a/", "http://x/a?utm_source=r", "http://x/none", "http://[bad", "http://x/b"]
    entries = stage(
        spark.createDataFrame(list(enumerate(links)), "entry_ord bigint, link string").withColumn(
            "feed_ord", F.lit(0)
        ),
        "entries",
    )
    landed = spark.createDataFrame(
        [(1, "http://x/a", "h", 200, 1), (2, "http://x/a/", "h", None, 2), (3, "http://x/b", "h", 404, 1)],
        "page_id bigint, url string, html string, status int, fetched_at int",
    )
    for hot_rows in (1, 1000):
        got = entry_pages(entries, landed, hot_rows).orderBy("entry_ord").collect()
        assert [(r.page_id, r.reject_reason) for r in got] == [
            (2, None), (2, None), (None, "no_page"), (None, "bad_link"), (None, "no_page"),
        ]


def test_bad_link_is_a_row_outcome(spark):
    df = spark.createDataFrame([("http://[x",), ("http://x",)], "link string")
    assert [r.reject_reason for r in with_link_outcome(df).collect()] == ["bad_link", None]


def test_pages_source(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "h", 200), (2, "u", "h", 301), (3, "v", "h", 503)],
                               "page_id bigint, url string, html string, status int")
    df.write.parquet(str(tmp_path / "p"))
    landed = read_pages(spark, str(tmp_path / "p"))
    assert sorted(r.page_id for r in landed.collect()) == [1, 2]
    assert [tuple(r) for r in newest_per_url(landed, "url").collect()] == [("u", 2)]
