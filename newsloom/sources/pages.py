"""Landed pages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def spread(df: DataFrame) -> DataFrame:
    """Give a scan of few, large file splits one partition per core.

    Only for plain scans: a table with enough splits, as any large one has, is
    returned as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def loaded_pages(pages: DataFrame) -> DataFrame:
    """Drop failed loads; tables without a ``status`` hold only good pages."""
    if "status" not in pages.columns:
        return pages
    return pages.filter(F.col("status").isNull() | (F.col("status") < 400))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return loaded_pages(spread(spark.read.parquet(path)))


def newest_per_url(pages: DataFrame, url_col: str, id_col: str = "page_id") -> DataFrame:
    """One id per address: the latest landing, ties by the greater id.

    Only narrow columns are aggregated, with map-side combining, so an address
    that landed very often is no hot spot.
    """
    stamp = F.col("fetched_at") if "fetched_at" in pages.columns else F.lit(0)
    narrow = pages.select(url_col, F.struct(stamp.alias("at"), F.col(id_col).alias("id")).alias("v"))
    return narrow.groupBy(url_col).agg(F.max("v")["id"].alias(id_col))
