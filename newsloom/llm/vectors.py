"""Vectors as whole numbers."""

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256


def is_whole(vector: Column) -> Column:
    """Not NULL, and neither NULL nor NaN nor infinite in any component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def whole_vectors(df: DataFrame, vector: str, others: Sequence[str]) -> DataFrame:
    """Rows with a usable vector: ``others`` and ``v``, floor(256 x) of every component x.

    Other rows go. A component that does not fit 32 bits then (of eight million or more)
    is an error.
    """
    ints = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    return df.filter(is_whole(F.col(vector))).select(*others, ints.alias("v"))


def matrix(vectors: pa.Array, dim: int) -> np.ndarray:
    """A list column without NULL as rows of ``dim`` numbers; shorter ones end in zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    ends = np.asarray(vectors.offsets)
    lengths = np.diff(ends)
    if (lengths == dim).all():
        return flat.reshape(len(vectors), dim)
    out = np.zeros((len(vectors), dim), flat.dtype)
    out[np.arange(dim) < lengths[:, None]] = flat
    return out
