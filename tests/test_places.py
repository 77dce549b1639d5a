"""Rows chosen by their places, and tables that go with their batch."""

import pytest
from pyspark.sql import functions as F

from newsloom.sources.places import bitmaps, located, picked
from newsloom.sources.staging import released, row_count, stage, stage_counted


def test_picked_rows_are_exact_and_not_shuffled(spark):
    one = located(stage(spark.range(0, 100_000, 1, 2).select("id", F.lit("a").alias("text")), "one"))
    two = located(stage(spark.range(-5, 0, 1, 1).select("id", F.lit("b").alias("text")), "two"))
    both = one.unionByName(two)
    chosen = bitmaps(both.filter("id % 7 = 0 OR id BETWEEN 32760 AND 32775 OR id = -5").select("_file", "_row"))
    got = picked([one, two], chosen)
    assert got.columns == one.columns
    wanted = sorted({*range(0, 100_000, 7), *range(32760, 32776), -5})
    assert sorted(r.id for r in got.select("id").collect()) == wanted
    shown = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in shown and "Exchange hashpartitioning" not in shown


def test_picked_takes_repeated_places_once_and_none(spark):
    rows = located(stage(spark.range(10), "ten"))
    places = rows.filter("id = 3").select("_file", "_row")
    assert [r.id for r in picked([rows], bitmaps(places.unionByName(places))).collect()] == [3]
    assert picked([rows], bitmaps(places.limit(0))).collect() == []


@pytest.mark.parametrize("fails", [False, True])
def test_released_tables_are_gone_and_settings_as_before(spark, fails):
    keys = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.parquet.compression.codec")
    before = [spark.conf.get(k, None) for k in keys]
    kept = stage_counted(spark.range(3), "kept")
    try:
        with released(spark):
            inner = stage_counted(spark.range(5).repartition(2), "inner")
            assert row_count(inner) == inner.count() == 5
            if fails:
                raise RuntimeError("lost")
    except RuntimeError:
        assert fails
    assert [spark.conf.get(k, None) for k in keys] == before
    assert kept.count() == 3
    path = spark._jvm.org.apache.hadoop.fs.Path(inner.inputFiles()[0])
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path.getParent())
