"""Written intermediate tables.

A staged table cuts lineage and survives the loss of executors; unlike a
checkpointed plan it is columnar, so later steps read only what they need.
"""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_DIR_KEY = "spark.checkpoint.dir"

# Paths of the tables that were staged within ``released``.
_held: ContextVar[list[str] | None] = ContextVar("held", default=None)
# What holds within ``released`` unless the session says otherwise: shuffle files go with
# their query and not when the driver collects its garbage, and texts are stored smaller.
_LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def staging_root(spark: SparkSession) -> str:
    """The shared folder the session names; a private one only in local mode."""
    named = spark.conf.get(_DIR_KEY, None) or spark.sparkContext.getConf().get(_DIR_KEY)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {_DIR_KEY} to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="newsloom-")
    spark.conf.set(_DIR_KEY, own)
    return own


def staging_path(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/newsloom-{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the staging root and read it back."""
    spark = df.sparkSession
    path = staging_path(spark, label)
    if (held := _held.get()) is not None:
        held.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Tables staged within are deleted at the end, so none of them may be in a result."""
    unset = [k for k in _LEAN if spark.conf.get(k, None) is None]
    for k in unset:
        spark.conf.set(k, _LEAN[k])
    held: list[str] = []
    mark = _held.set(held)
    try:
        yield
    finally:
        _held.reset(mark)
        for k in unset:
            spark.conf.unset(k)
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in map(at, held):
            path.getFileSystem(conf).delete(path, True)


def stage_counted(df: DataFrame, label: str) -> DataFrame:
    """As ``stage``; the rows are counted as they are written, for ``row_count``."""
    written = Observation()
    staged = stage(df.observe(written, F.count(F.lit(1)).alias("n")), label)
    staged.staged_rows = written.get["n"]
    return staged


def same_rows(df: DataFrame, staged: DataFrame) -> DataFrame:
    """``df``, a projection of ``staged``, with its row count if that is known."""
    df.staged_rows = vars(staged).get("staged_rows")
    return df


def row_count(df: DataFrame) -> int:
    """Rows of a staged table, by what its writer counted if it did."""
    known = vars(df).get("staged_rows")
    return df.count() if known is None else known


def table_at(spark: SparkSession, path: str, schema: StructType, parts: tuple[str, ...] = ()) -> DataFrame:
    """The Parquet table at ``path``, made empty first if there is none; one that can't be read raises."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*parts).parquet(path)
    return spark.read.schema(schema).parquet(path)
