"""Sharding by longest processing time: groups go, largest first, to the least-loaded shard."""

import heapq
from collections.abc import Iterable
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.sources.staging import stage

ROW_BYTES = 16
PARTS_PER_SHARD = 64
ROWS_PER_SLICE = 20_000


def longest_first(items: Iterable[tuple[object, int]], shards: int) -> dict[object, int]:
    """Shard of each item: by falling size, ties by item, each to the least-loaded shard."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for item, size in sorted(items, key=lambda x: (-x[1], x[0])):
        load, shard = heap[0]
        placed[item] = shard
        heapq.heapreplace(heap, (load + size, shard))
    return placed


def assign_shards(
    rows: DataFrame,
    group: list[str],
    size: str,
    shards: int,
    order: list[str],
    parts_per_shard: int = PARTS_PER_SHARD,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (0, 1, 2 ... within the shard, by slices and ``order``).

    Rows that agree in ``group`` (NULL agrees with NULL) stay together. Groups larger
    than a share of 1 / (shards * parts_per_shard) of all bytes are scheduled one by
    one; there are fewer than shards * parts_per_shard of them. The smaller ones are
    first put together, whole, into as many parcels, by a hash. So the heap holds at
    most 2 * shards * parts_per_shard entries at any size of the table, and the table
    of their shards may be broadcast. Equal rows get different slots; an empty table
    gives an empty result. ``rows`` should be narrow: they are shuffled twice.
    """
    spark = rows.sparkSession
    parcels = shards * parts_per_shard
    keyed = stage(rows.withColumn("__key", F.xxhash64(*group)), "shard-rows")
    sizes = stage(
        keyed.groupBy(*group, "__key").agg(
            F.sum(size).alias("__bytes"), F.count("*").alias("__rows")
        ),
        "shard-groups",
    )
    whole = sizes.agg(F.sum("__bytes"), F.sum("__rows")).first()
    total, n_rows = whole[0] or 0, whole[1] or 0
    large = sizes.filter(F.col("__bytes") * parcels > total).select(
        F.col("__key"), F.col("__bytes")
    )
    # Groups whose keys collide stay together, which is harmless.
    singles = {r[0]: r[1] for r in large.groupBy("__key").agg(F.sum("__bytes")).collect()}
    known = spark.createDataFrame([(k,) for k in singles], "__single bigint")
    sorted_out = sizes.join(
        F.broadcast(known), F.col("__key") == F.col("__single"), "left"
    ).filter(F.col("__single").isNull())
    parcel = F.pmod(F.col("__key"), F.lit(parcels))
    bundles = sorted_out.groupBy(parcel.alias("__parcel")).agg(F.sum("__bytes")).collect()
    placed = longest_first(
        [(("group", k), v) for k, v in singles.items()] + [(("parcel", r[0]), r[1]) for r in bundles],
        shards,
    )
    alone = spark.createDataFrame(
        [(k, placed["group", k]) for k in singles], "__single bigint, __alone int"
    )
    shared = spark.createDataFrame(
        [(r[0], placed["parcel", r[0]]) for r in bundles], "__parcel bigint, __shared int"
    )
    slices = max(1, ceil(n_rows / (shards * rows_per_slice)))
    dealt = (
        keyed.withColumn("__parcel", parcel)
        .join(F.broadcast(alone), F.col("__key") == F.col("__single"), "left")
        .join(F.broadcast(shared), "__parcel", "left")
        .withColumn("shard", F.coalesce("__alone", "__shared"))
        .withColumn("__slice", F.pmod(F.xxhash64(*order, F.lit(7)), F.lit(slices)).cast("int"))
    )
    before = Window.partitionBy("shard").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "__slice")
        .agg(F.count("*").alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    within = Window.partitionBy("shard", "__slice").orderBy(*order)
    return (
        dealt.join(offsets, ["shard", "__slice"])
        .withColumn("slot", F.row_number().over(within).cast("bigint") - 1 + F.col("__before"))
        .select(*rows.columns, "shard", "slot")
    )


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: sizes near equal, copies together.

    Size: UTF-8 bytes of the text and 16. NULL text has no bytes and lies with the
    empty texts. NULL and repeated ids are rows like others.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text).cast("bigint") + ROW_BYTES).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("__text_key"),
    )
    placed = assign_shards(
        narrow, ["__text_key", "text_crc32", "size"], "size", shards, ["doc_id", "__text_key"]
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
