"""The registered queries of this subpackage, with production parameters, and their SQL."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    decontamination, fill_in_middle, line_dedup, ngram_join, quality_classifier, quality_rules, sentence_pieces, sharding,
    site_style, token_files, top_k, url_filters, vector_codes,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source."""
    cut = line_dedup.drop_frequent_lines(table(spark, sf_dir, "documents"), "source")
    return cut.select("doc_id", "n_lines", "n_dropped", "text")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a capture, against dated entries made from all pages."""
    pages = table(spark, sf_dir, "pages")
    return url_filters.judge_captures(url_filters.captures_of(pages), url_filters.entries_of(pages))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text decoded from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentence_pieces.encode_and_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_tokens", "ids", "decoded", "round_trip", "differing")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in any document."""
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.find_leaks(docs, items)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, probability of the best grade and decision for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = quality_classifier.rate_documents(docs, table(spark, sf_dir, "labels"))
    return rated.select("doc_id", "expected_grade", "p_good", "kept")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_groups(table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 40)


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return token_files.token_files(table(spark, sf_dir, "documents"), tokenizer)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.extract_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five rows nearest to every fiftieth vector, among all."""
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % top_k.EVERY == 0)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(table(spark, sf_dir, "embeddings"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How every document is cut, with digests of the output and of the text rebuilt from it."""
    made = fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        F.col("n_units").alias("n"),
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_url_filters": op2_url_filters,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_decontamination": op4_decontamination,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_quality_rules": op6_quality_rules,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_sharding": op8_sharding,
    "op9_token_output": op9_token_output,
    "op10_html_extraction": op10_html_extraction,
    "op11_top_k": op11_top_k,
    "op12_vector_codes": op12_vector_codes,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": line_dedup.ORACLE_SQL,
    "op2_url_filters": url_filters.ORACLE_SQL,
    "op6_quality_rules": quality_rules.ORACLE_SQL,
    "op11_top_k": top_k.ORACLE_SQL,
    "op12_vector_codes": vector_codes.ORACLE_SQL,
    "op13_fill_in_middle": fill_in_middle.ORACLE_SQL,
}
