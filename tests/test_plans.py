"""Shapes of physical plans: pruning, pushdown, no cross joins."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from newsloom import append_articles, existing_keys, open_store
from newsloom.catalog import queries as q
from newsloom.catalog import render
from newsloom.plans.ingest import entry_pages

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_scans_read_only_what_they_need(spark, tmp_path):
    assert "ReadSchema: struct<page_id:bigint,url:string>" in formatted(q.normalize_url(spark, SF))
    path = str(tmp_path / "s")
    append_articles(render.document_articles(render.documents(spark, SF), F.col("lang")), path)
    store = open_store(spark, path)
    keys = formatted(existing_keys(store).filter("profile = 'en'"))
    assert "ReadSchema: struct<id_article:string,content_hash:string>" in keys
    assert "PartitionFilters: [isnotnull(profile" in keys


def test_staged_rows_are_filtered_in_the_scan(spark):
    kept = q.not_thin(spark, SF)
    assert "IsNull(reject_reason)" in formatted(kept)


def test_extraction_needs_no_shuffle_of_its_own(spark):
    from newsloom.operators.body import page_body
    from newsloom.operators.dom import dom_nodes
    from newsloom.operators.metadata import with_metadata

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    text = plan(page_body(with_metadata(dom_nodes(pages))))
    assert "Exchange" not in text
    assert len(re.findall("MapInArrow", text)) == 1


def test_markup_stays_out_of_the_entry_join(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    entries = docs.select(F.lit(0).alias("feed_ord"), F.col("doc_id").alias("entry_ord"), F.lit("x").alias("link"))
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    assert "html" not in plan(entry_pages(entries, pages))


@pytest.mark.parametrize("name", ["entries_capped_table", "entry_pages", "new_by_hash", "feed_entries"])
def test_no_cross_joins(spark, name):
    text = plan(entry_points.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_rendered_feeds_are_bounded(spark):
    docs = render.documents(spark, SF)
    sizes = docs.groupBy(render.feed_ordinal().alias("f")).count().agg(F.max("count")).first()[0]
    assert sizes <= render.FEED_RUN


def test_markup_is_never_exchanged(spark):
    """Without broadcasts, and with filters too small to tell anything apart."""
    from newsloom.operators import amp, membership
    from newsloom.operators.dom import dom_nodes
    from newsloom.operators.metadata import with_metadata
    from newsloom.sources.staging import stage_counted

    seen = []
    real = amp.clean_paragraphs

    def noted(df, *args):
        out = real(df, *args)
        seen.append(plan(out))
        return out

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        landed = render.render_bodies(render.documents(spark, SF))
        landed = stage_counted(landed, "landed")
        with pytest.MonkeyPatch.context() as m:
            m.setattr(amp, "clean_paragraphs", noted)
            m.setattr(membership, "MOST_BITS", 1 << 10)
            got = amp.amp_body(with_metadata(dom_nodes(landed)), landed).select("page_id", "amp_text")
            n_long = got.filter("amp_text <> ''").count()
        assert n_long and "Exchange" not in seen[0] and "MapInArrow" in seen[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
