"""Documents to token ids: quality, lines, near copies, benchmark leaks, encoding."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import decontamination, line_dedup, ngram_join, quality_classifier, sentence_pieces
from newsloom.sources.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _apart(docs: DataFrame, *used: str) -> DataFrame:
    """The columns that a stage uses, and all others in one, so that no names clash."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in used]
    return docs.select(F.struct(F.lit(1).alias("__one"), *others).alias("__documents"), *used)


def _together(df: DataFrame, docs: DataFrame, *used: str) -> list:
    """The columns of ``docs``, in their order, out of ``df``."""
    return [F.col(c) if c in used else F.col(f"__documents.`{c}`").alias(c) for c in docs.columns]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps; it is fitted on the labels of ``docs``."""
    used = ("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rated = quality_classifier.rate_documents(_apart(docs, *used), labels)
    return rated.filter("kept").select(*_together(rated, docs, *used))


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go, and n_chars follows; every document stays."""
    used = ("text", "source", "n_chars")
    cut = line_dedup.drop_frequent_lines(_apart(docs, *used), "source")
    length = F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars"))
    cut = cut.withColumn("n_chars", length.cast("bigint"))
    return cut.select(*_together(cut, docs, *used))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    used = ("doc_id", "text")
    return ngram_join.one_of_each(_apart(docs, *used)).select(*_together(docs, docs, *used))


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    clean = decontamination.decontaminate(_apart(docs, "text"), items)
    return clean.select(*_together(clean, docs, "text"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its ids, and whether they decode to its text.

    Columns of ``docs`` named as the added ones come back as ``documents_...``.
    """
    added = ("n_tokens", "ids", "round_trip")
    coded = sentence_pieces.encode_and_decode(_apart(docs, "text"), public_tokenizers.path("piece_bpe_32k.model"))
    own = [c.alias(f"documents_{n}") if n in added else c for n, c in zip(docs.columns, _together(coded, docs, "text"))]
    return coded.select(*own, *added)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("lines", clean_lines),
    ("near-copies", distinct_documents),
    ("leaks", without_leaks),
    ("tokens", token_ids),
]

#: The classifier and the tokenizer can't be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
