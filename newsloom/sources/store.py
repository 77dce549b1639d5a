"""The article store: a Parquet table partitioned by profile, and its CSV form.

One writer per profile at a time is a precondition.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.schemas import ARTICLE_COLUMNS, ARTICLE_SCHEMA, STORE_SCHEMA
from newsloom.sources.keys import index_keys
from newsloom.sources.staging import table_at

_CSV = {"header": True, "quote": '"', "escape": '"'}
_SLICES = 64
# A file with line breaks in its values is read by one task, so files stay small.
_CSV_ROWS_PER_FILE = 100_000


def open_store(spark: SparkSession, path: str) -> DataFrame:
    """Read the store, creating an empty one first if there is none.

    The schema is explicit: keys made of digits only stay strings.  A store
    that cannot be read raises; de-duplication is never silently switched off.
    """
    return table_at(spark, path, STORE_SCHEMA, ("profile",))


def existing_keys(store: DataFrame) -> DataFrame:
    """Both keys of every stored article; NULL hashes for a legacy store."""
    content_hash = (
        F.col("content_hash")
        if "content_hash" in store.columns
        else F.lit(None).cast("string").alias("content_hash")
    )
    scope = [c for c in ("profile",) if c in store.columns]
    return store.select(*scope, "id_article", content_hash)


def append_articles(articles: DataFrame, path: str) -> None:
    """Append in one commit, then index the keys; columns are brought into the store's order.

    Rows are rebalanced by profile and a slice of the id: small parts are merged
    into files of a sensible size, and a profile that holds most of the rows is
    dealt to many tasks.
    """
    rows = articles.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in STORE_SCHEMA.fields]
    )
    sliced = rows.withColumn("_slice", F.pmod(F.xxhash64("id_article"), F.lit(_SLICES)))
    rows = sliced.hint("rebalance", F.col("profile"), F.col("_slice")).drop("_slice")
    rows.write.mode("append").partitionBy("profile").parquet(path)
    index_keys(articles.sparkSession, path)


def export_csv(store: DataFrame, path: str) -> None:
    """Write the article columns as CSV with a header; NULL and "" look the same."""
    (
        store.select(*ARTICLE_COLUMNS)
        .write.options(
            **_CSV,
            emptyValue="",
            maxRecordsPerFile=_CSV_ROWS_PER_FILE,
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        .csv(path)
    )


def import_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read an exported CSV; bodies contain line breaks, hence ``multiLine``."""
    return spark.read.schema(ARTICLE_SCHEMA).options(**_CSV, multiLine=True).csv(path)
