"""Which rows of a wide table have a wanted key, told in the scan by a Bloom filter.

The filter is one row of a staged table, at most 8 MB whatever the number of keys, and is
read through a scalar subquery. The wide table is neither joined nor shuffled, at any size
of either side. A few unwanted rows pass (more of them once there are many millions of
keys, and in the end all), so an exact join on narrow columns must follow.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.sources.staging import row_count, stage

HASHES = 4
BITS_PER_KEY = 16
MOST_BITS = 1 << 26


def _places(key: Column, bits: int) -> list[Column]:
    """The bits of a key; the size is a power of two."""
    return [F.xxhash64(F.lit(i), key).bitwiseAND(F.lit(bits - 1)) for i in range(HASHES)]


def _filter_row(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row with the filter as an array of 64-bit words."""
    places = keys.select(F.explode(F.array(*_places(F.col(key), bits))).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    words = places.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit).alias("set"))
    every = keys.sparkSession.range(bits // 64).withColumnRenamed("id", "word")
    filled = every.join(words, "word", "left").select("word", F.coalesce("set", F.lit(0).cast("bigint")).alias("set"))
    pairs = F.array_sort(F.collect_list(F.struct("word", "set")))
    return filled.agg(F.transform(pairs, lambda p: p["set"]).alias("words"))


def likely_members(wide: DataFrame, keys: DataFrame, key: str, most_bits: int = MOST_BITS) -> DataFrame:
    """Rows of ``wide`` whose ``key`` is in ``keys`` (staged), and few others."""
    wanted = max(1, row_count(keys)) * BITS_PER_KEY
    bits = min(most_bits, 1 << max(10, wanted.bit_length()))
    words = stage(_filter_row(keys, key, bits), "members").select("words").scalar()

    def is_set(place: Column) -> Column:
        word = F.get(words, F.shiftright(place, 6).cast("int"))
        return F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1

    return wide.filter(reduce(and_, map(is_set, _places(F.col(key), bits))))
