"""Keys of a store, clustered by hash, so that a small batch reads few files.

    <store>/_keys/rows/bucket=NN   profile, kind ("id" or "hash"), key
    <store>/_keys/files            names of the data files whose keys are in ``rows``

Spark takes names that begin with an underscore for no data of the store. A file counts as
indexed once its name is in ``files``, which is written last; the keys of all other files
are read from the files themselves. So a run that ends between any two writes loses
nothing, and a store without an index is merely read in full.
"""

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators.joins import checked_broadcast
from newsloom.schemas import STORE_SCHEMA
from newsloom.sources.staging import stage_counted, table_at

BUCKETS = 64

_FILES = T.StructType([T.StructField("file", T.StringType())])
_ROWS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("profile", "kind", "key")] + [T.StructField("bucket", T.IntegerType())]
)


def key_rows(df: DataFrame, id_col: str = "id_article", hash_col: str = "content_hash") -> DataFrame:
    """``profile, kind, key, bucket``: two rows for each row, without NULL keys."""
    kinds = [F.struct(F.lit("id").alias("kind"), F.col(id_col).alias("key"))]
    if hash_col in df.columns:
        kinds.append(F.struct(F.lit("hash").alias("kind"), F.col(hash_col).alias("key")))
    bucket = F.pmod(F.xxhash64("kind", "key"), F.lit(BUCKETS)).cast("int")
    return (
        df.select("profile", F.explode(F.array(*kinds)).alias("k"))
        .select("profile", "k.kind", "k.key")
        .filter(F.col("key").isNotNull())
        .withColumn("bucket", bucket)
    )


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return table_at(spark, path, schema, ("bucket",) if "bucket" in schema.names else ())


def _store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE_SCHEMA).parquet(path)


def _not_indexed(spark: SparkSession, path: str) -> tuple[DataFrame | None, list[str]]:
    """Rows of the data files that have no keys in the index, and the files' names."""
    store = _store(spark, path)
    present = {PurePosixPath(f).name for f in store.inputFiles()}
    known = {r.file for r in _read(spark, f"{path}/_keys/files", _FILES).collect()}
    new = sorted(present - known)
    if not new:
        return None, new
    # A condition on file names is applied to the list of files, before any is opened.
    return (store.filter(F.col("_metadata.file_name").isin(new)) if present & known else store), new


def index_keys(spark: SparkSession, path: str) -> None:
    """Bring the keys of new data files into the index; the store must exist."""
    rows, files = _not_indexed(spark, path)
    if rows is None:
        return
    _write(spark, path, rows, files)


def rebuild_keys(spark: SparkSession, path: str) -> None:
    """Write the index anew, one file for each bucket instead of one for each append."""
    _read(spark, f"{path}/_keys/files", _FILES)
    spark.createDataFrame([], _FILES).write.mode("overwrite").parquet(f"{path}/_keys/files")
    spark.createDataFrame([], _ROWS).write.mode("overwrite").parquet(f"{path}/_keys/rows")
    index_keys(spark, path)


def _write(spark: SparkSession, path: str, rows: DataFrame, files: list[str]) -> None:
    keys = key_rows(rows).hint("rebalance", F.col("bucket"))
    keys.write.mode("append").partitionBy("bucket").parquet(f"{path}/_keys/rows")
    names = spark.range(0, 1, 1, 1).select(F.explode(F.lit(files)).alias("file"))
    names.write.mode("append").parquet(f"{path}/_keys/files")


def indexed_keys(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Index rows in the buckets that ``keys`` (with ``bucket``) fall into."""
    rows = _read(spark, f"{path}/_keys/rows", _ROWS)
    buckets = sorted(r.bucket for r in keys.select("bucket").distinct().collect())  # at most BUCKETS
    return rows.filter(F.col("bucket").isin(buckets))


def stored_among(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """Which of the keys (``key_rows`` of a staged table) the store has: ``profile, kind, key``; staged.

    One scan answers for both kinds. It reads the buckets of the wanted keys, and the files
    that the index does not have yet.
    """
    found = indexed_keys(spark, path, keys)
    fresh, _ = _not_indexed(spark, path)
    if fresh is not None:
        found = found.unionByName(key_rows(fresh))
    on = ["profile", "kind", "key"]
    wanted = checked_broadcast(keys.select(*on).distinct(), keys)
    return stage_counted(found.select(*on).join(wanted, on, "left_semi").distinct(), "stored")
