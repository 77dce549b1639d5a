"""What a stream of batches leaves beside the store: a log, outcomes, waiting pages, landings.

    <store>/_log                    one row for each step of a batch that is through
    <store>/_batches/decided/seq=N  outcome of every page that batch N decided
    <store>/_batches/waiting/seq=N  pages that wait for their AMP twin after batch N
    <store>/_landed/bucket=NN       address, id and file of every page that landed

Spark takes names that begin with an underscore for no data of the store. A batch first
writes its decisions, then logs ``decided``, appends, and logs ``done``; folders of a batch
that is not logged count for nothing and are overwritten. One writer at a time is a
precondition, as for the store.
"""

from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.operators.joins import checked_broadcast
from newsloom.sources.staging import stage_counted, table_at

DECIDED, DONE = "decided", "done"
BUCKETS = 64

_LOG = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch", T.LongType()),
        T.StructField("step", T.StringType()),
    ]
)
DECIDED_SCHEMA = T.StructType(
    [
        T.StructField("profile", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("ord", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("hash", T.StringType()),
        T.StructField("outcome", T.StringType()),
    ]
)
_LANDED = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("fetched_at", T.TimestampType()),
        T.StructField("file", T.StringType()),
        T.StructField("bucket", T.IntegerType()),
    ]
)


class Place(NamedTuple):
    """Where a batch stands: its number, whether its decisions are written, and the last finished batch."""

    seq: int
    decided: bool
    done: bool
    before: int | None


def log(spark: SparkSession, store: str) -> DataFrame:
    return table_at(spark, f"{store}/_log", _LOG)


def place(spark: SparkSession, store: str, run: str, batch: int) -> Place:
    """Where batch ``batch`` of run ``run`` stands."""
    rows = log(spark, store)
    mine = F.when((F.col("run") == run) & (F.col("batch") == batch), F.col("seq"))
    of = lambda step, seq: F.max(F.when(F.col("step") == step, seq))
    last, decided, done = rows.agg(of(DONE, F.col("seq")), of(DECIDED, mine), of(DONE, mine)).first()
    if done is not None:
        return Place(done, True, True, last)
    return Place((last or 0) + 1, decided is not None, False, last)


def note(spark: SparkSession, store: str, seq: int, run: str, batch: int, step: str) -> None:
    values = (seq, run, batch, step)
    entry = [F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, _LOG.fields)]
    spark.range(0, 1, 1, 1).select(*entry).write.mode("append").parquet(f"{store}/_log")


def write_part(rows: DataFrame, store: str, kind: str, seq: int) -> None:
    rows.write.mode("overwrite").parquet(f"{store}/_batches/{kind}/seq={seq}")


def read_part(spark: SparkSession, store: str, kind: str, seq: int, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{store}/_batches/{kind}/seq={seq}")


def waiting(spark: SparkSession, store: str, schema: T.StructType) -> DataFrame:
    """The pages that wait after the last finished batch."""
    last = log(spark, store).filter(F.col("step") == DONE).agg(F.max("seq")).first()[0]
    if last is None:
        return table_at(spark, f"{store}/_batches/waiting/seq=0", schema)
    return read_part(spark, store, "waiting", last, schema)


def decided(spark: SparkSession, store: str) -> DataFrame:
    """Outcomes of all finished batches."""
    finished = log(spark, store).filter(F.col("step") == DONE).select("seq").distinct()
    if finished.isEmpty():
        return spark.createDataFrame([], DECIDED_SCHEMA)
    schema = T.StructType([*DECIDED_SCHEMA.fields, T.StructField("seq", T.LongType())])
    rows = spark.read.schema(schema).parquet(f"{store}/_batches/decided")
    return rows.join(finished, "seq", "left_semi").drop("seq")


# --- landings -----------------------------------------------------------------


def _bucket(url: str):
    return F.pmod(F.xxhash64(url), F.lit(BUCKETS)).cast("int")


def landed_rows(batch: DataFrame) -> DataFrame:
    """Narrow rows of a batch of loaded pages with ``file``."""
    stamp = F.col("fetched_at") if "fetched_at" in batch.columns else F.lit(None)
    return batch.filter(F.col("url").isNotNull()).select(
        "url", "page_id", stamp.cast("timestamp").alias("fetched_at"), "file", _bucket("url").alias("bucket")
    )


def land(rows: DataFrame, store: str) -> None:
    """Add a batch's landings; a batch that is added twice changes nothing."""
    rows.hint("rebalance", F.col("bucket")).write.mode("append").partitionBy("bucket").parquet(f"{store}/_landed")


def newest_landings(spark: SparkSession, store: str, batch: DataFrame, wanted: DataFrame) -> DataFrame:
    """Newest landing (``amp_href, page_id, file``) at each wanted address (staged ``amp_href``); staged.

    Of the earlier landings only the buckets of the wanted addresses are read.
    """
    buckets = [r[0] for r in wanted.select(_bucket("amp_href")).distinct().collect()]  # at most BUCKETS
    earlier = table_at(spark, f"{store}/_landed", _LANDED, ("bucket",)).filter(F.col("bucket").isin(buckets))
    both = earlier.unionByName(batch).withColumnRenamed("url", "amp_href")
    found = both.join(checked_broadcast(wanted.select("amp_href").distinct(), wanted), "amp_href", "left_semi")
    newest = found.groupBy("amp_href").agg(F.max(F.struct("fetched_at", "page_id", "file")).alias("l"))
    return stage_counted(newest.select("amp_href", "l.page_id", "l.file"), "landings")


def files_of(landings: DataFrame) -> list[str]:
    """The files of the landings, as paths; there are no more of them than files in the landing folder."""
    return sorted(unquote(r.file) for r in landings.select("file").distinct().collect())
