"""The store's key index: what it reads, and what a lost write does to it."""

import pytest
from pyspark.sql import functions as F

from newsloom import append_articles, open_store
from newsloom.plans.ingest import drop_known
from newsloom.sources import keys as keys_of
from newsloom.sources.staging import stage, stage_counted
from test_store import articles


def rows(spark, start, n, profile="p"):
    return articles(spark, *[(profile, i, f"id{i}", f"hash{i}") for i in range(start, start + n)])


def new(spark, path, batch, by=("id_article", "content_hash")):
    return sorted(r.entry_ord for r in drop_known(stage(batch, "batch"), path, by).collect())


def test_a_small_batch_reads_few_files(spark, tmp_path):
    path = str(tmp_path / "store")
    for i in range(3):
        append_articles(rows(spark, 1000 * i, 1000), path)
    batch = stage_counted(keys_of.key_rows(rows(spark, 5, 1)), "wanted")
    found = keys_of.indexed_keys(spark, path, batch)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in text and "content" not in text
    opened = found.select(F.input_file_name().alias("f")).distinct().count()
    every = spark.read.parquet(f"{path}/_keys/rows").select(F.input_file_name().alias("f")).distinct().count()
    assert every >= 3 * keys_of.BUCKETS * 0.9
    assert opened <= 2 * 3
    assert keys_of._not_indexed(spark, path) == (None, [])
    # Both keys of a batch are looked up in one scan of the index.
    hits = keys_of.stored_among(spark, path, batch)
    assert sorted(tuple(r) for r in hits.collect()) == [("p", "hash", "hash5"), ("p", "id", "id5")]
    keys_of.rebuild_keys(spark, path)
    assert new(spark, path, rows(spark, 2995, 10)) == list(range(3000, 3005))
    again = keys_of.indexed_keys(spark, path, batch).select(F.input_file_name().alias("f")).distinct().count()
    assert again <= 2


def test_without_an_index_the_store_itself_is_read(spark, tmp_path):
    path = str(tmp_path / "store")
    open_store(spark, path)
    rows(spark, 0, 20).write.mode("append").partitionBy("profile").parquet(path)
    assert new(spark, path, rows(spark, 15, 10)) == list(range(20, 25))
    append_articles(rows(spark, 20, 5), path)
    assert new(spark, path, rows(spark, 15, 12)) == [25, 26]
    # Keys are scoped by profile, and NULL hashes match nothing.
    assert new(spark, path, rows(spark, 0, 2, "q")) == [0, 1]
    append_articles(rows(spark, 50, 1).withColumn("content_hash", F.lit(None).cast("string")), path)
    assert new(spark, path, rows(spark, 50, 2)) == [51]
    assert new(spark, path, rows(spark, 50, 2), ("id_article",)) == [51]


@pytest.mark.parametrize("lost", ["both", "files"])
def test_an_append_whose_index_was_lost_counts(spark, tmp_path, monkeypatch, lost):
    path = str(tmp_path / "store")
    append_articles(rows(spark, 0, 5), path)

    def crash(spark, path, rows, files):
        if lost == "files":
            keys_of.key_rows(rows).write.mode("append").partitionBy("bucket").parquet(f"{path}/_keys/rows")
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(keys_of, "_write", crash)
        with pytest.raises(RuntimeError):
            append_articles(rows(spark, 5, 5), path)
    assert new(spark, path, rows(spark, 3, 9)) == [10, 11]
    append_articles(rows(spark, 10, 1), path)
    assert new(spark, path, rows(spark, 3, 9)) == [11]
    assert open_store(spark, path).count() == 11
