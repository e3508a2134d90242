"""The named queries over the operators of this package, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodework.llm import (bpe, crf, decontaminate, extract, importance, jaccard, langid, quality, sharding, tokenfiles, trie,
                          urls, warc)
from lodework.llm.common import table

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def _sha256(text) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def digests(docs: DataFrame) -> DataFrame:
    """``n_tokens``, and digests of a document's ids and of the text decoded from them."""
    both = docs.select("doc_id", bpe.round_trip(F.col("text"), public_tokenizers.path(WORD_BPE)).alias("told"))
    return both.select("doc_id", "told.*").select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       _sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
                       _sha256(F.col("decoded")).alias("decoded_sha256"))


def op1_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        _sha256(F.array_join("items", ",")).alias("items_sha256"), "contaminated")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations"))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_chunk_reuse": op1_bpe_chunk_reuse,
    "op2_html_extraction": op2_html_extraction,
    "op3_sharding": op3_sharding,
    "op4_language_id": op4_language_id,
    "op5_decontamination": op5_decontamination,
    "op6_url_filter": op6_url_filter,
    "op7_warc": op7_warc,
    "op8_token_files": op8_token_files,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_quality_classifier": op12_quality_classifier,
    "op13_importance_resampling": op13_importance_resampling,
}
