"""Rows of staged tables, named by where they stand and read again without a join of wide rows.

A row's place is the name of its file, which no other file has, and its number in that
file. What is decided on narrow columns is told to the wide tables by bitmaps, one bit
for each row of a file up to the last block with a chosen row: 125 MB for a milliard rows.
They are broadcast, so wide rows are chosen in the scan, exactly, and are not shuffled.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.sources.staging import row_count, same_rows, stage_counted

PLACE = ("_file", "_row")
# Rows that one of Spark's bitmaps covers.
_BLOCK = 1 << 15


def located(table: DataFrame) -> DataFrame:
    """A table just as it is read from Parquet files, with the place of each row."""
    at = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    return same_rows(table.select("*", *at), table)


def bitmaps(places: DataFrame) -> DataFrame:
    """The places (``_file, _row``, repeats allowed) as bits; staged."""
    block = F.floor(F.col("_row") / _BLOCK).alias("_block")
    bits = F.bitmap_construct_agg(F.col("_row") % _BLOCK).alias("_bits")
    return stage_counted(places.groupBy("_file", block).agg(bits), "bitmaps")


def picked(tables: Sequence[DataFrame], chosen: DataFrame) -> DataFrame:
    """Rows of the located tables (of the same columns) that stand at the places ``chosen`` (``bitmaps``)."""
    if not row_count(chosen):
        return tables[0].limit(0)
    at = F.col("_row") % _BLOCK
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10)
    is_set = F.getbit(byte.cast("int"), (at % 8).cast("int")) == 1

    def pick(table: DataFrame) -> DataFrame:
        blocks = table.withColumn("_block", F.floor(F.col("_row") / _BLOCK))
        return blocks.join(F.broadcast(chosen), ["_file", "_block"]).filter(is_set).select(table.columns)

    return reduce(DataFrame.unionByName, map(pick, tables))
