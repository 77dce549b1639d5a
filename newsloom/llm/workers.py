"""What tasks need of their Python workers: the package's code, and little memory between tasks."""

import ctypes
import gc
import os
import sys

import pyarrow as pa
from pyspark.sql import DataFrame

import newsloom


def with_code(df: DataFrame) -> DataFrame:
    """``df``, whose Python workers look for modules where the driver found this package.

    Tasks import it, so that what a worker has learnt outlives a task. On a cluster the
    package must be installed at that place or shipped with ``addPyFile``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(newsloom.__file__)))
    environment = df.sparkSession.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return df


def release() -> None:
    """Give freed memory back to the system: workers outlive their tasks, and idle ones count."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)
