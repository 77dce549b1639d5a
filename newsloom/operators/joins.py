"""Equi-joins that stay balanced when one key holds much of the left side."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.sources.staging import row_count, stage

# A key with more rows than this is split into pieces of about this many rows.
# At most N / HOT_ROWS keys can be hot, and only their 64-bit hashes are
# broadcast: 16 bytes per million left rows, and never more than TRACKED keys.
HOT_ROWS = 1_000_000

# Keys that a sketch keeps; it counts a key at most N * 3.5 / (2 * TRACKED) rows short.
TRACKED = 1 << 15
# Sketches of that many groups of partitions are merged apart from each other first.
_MERGERS = 64


def hot_keys(left: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Hashes of the hot keys with the number of pieces each is split into.

    Counted by a sketch of bounded size, so that one sketch per partition is
    shuffled and not every key.  A key of fewer than some N / 18,000 rows may be
    missed however many rows that is; it stays in one piece, which is no more than
    its share of a cluster of thousands of tasks.  Two keys sharing a hash are
    merely split both, on both sides of the join alike.
    """
    hashes = left.select(F.xxhash64(*on).alias("_k"), (F.spark_partition_id() % _MERGERS).alias("_part"))
    sketches = hashes.groupBy("_part").agg(F.expr(f"approx_top_k_accumulate(_k, {TRACKED})").alias("s"))
    # Grouped by a constant, so that an empty table gives no row instead of an empty sketch.
    counts = sketches.withColumn("_all", F.lit(0)).groupBy("_all").agg(F.expr(f"approx_top_k_combine(s, {TRACKED})").alias("s")).select(
        F.explode(F.expr(f"approx_top_k_estimate(s, {TRACKED})")).alias("x")
    )
    return counts.filter(F.col("x.count") > hot_rows).select(
        F.col("x.item").alias("_k"), F.ceil(F.col("x.count") / hot_rows).cast("int").alias("_pieces")
    )


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    spread_by: list[str | Column],
    base: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``left`` (hot keys allowed) with ``right`` (one row per key).

    Rows of a hot key are dealt to several pieces by ``spread_by``; the one
    right row of that key is repeated per piece, all other keys stay in one.
    The right side grows by at most N / hot_rows rows.

    ``base`` (default: ``left``) is a staged table that contains the rows of
    ``left``.  It is counted first: no key of a table of up to ``hot_rows`` rows
    can be hot, and the join is then a plain one.
    """
    base = left if base is None else base
    if row_count(base) <= hot_rows:
        return left.join(right, on, how)
    # Written, as two runs of a sketch may count differently and both sides need the same pieces.
    hot = F.broadcast(stage(hot_keys(base, on, hot_rows), "hot"))
    lefts = (
        left.withColumn("_k", F.xxhash64(*on))
        .join(hot, "_k", "left")
        .withColumn(
            "_piece",
            F.when(
                F.col("_pieces").isNotNull(),
                F.pmod(F.xxhash64(*spread_by), F.col("_pieces")).cast("int"),
            ).otherwise(F.lit(0)),
        )
        .drop("_k", "_pieces")
    )
    rights = (
        right.withColumn("_k", F.xxhash64(*on))
        .join(hot, "_k", "left")
        .withColumn(
            "_piece",
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)),
        )
        .drop("_k", "_pieces")
    )
    return lefts.join(rights, [*on, "_piece"], how).drop("_piece")


# Key rows up to this number are broadcast: some 100 MB of ids or hashes.
BROADCAST_ROWS = 1_000_000


def checked_broadcast(keys: DataFrame, base: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``keys`` for broadcast if the staged table they come from is small."""
    return F.broadcast(keys) if row_count(base) <= max_rows else keys

