"""The corpus pipeline: from raw documents to the token ids of those worth training on.

Each stage takes all that its predecessor kept, as a written table, and its decisions
take effect. All stages but the last return the columns of ``documents``; the last
returns ``doc_id``, the number of tokens, and digests of the ids and of the decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodework.llm import decontaminate, jaccard, langid, quality
from lodework.llm.common import stored, table
from lodework.llm.queries import digests


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or are depleted; drop their host's frequent lines from the others."""
    return quality.clean(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language, or whose language is ambiguous."""
    return langid.clean(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return jaccard.clean(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents contaminated with benchmark items."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the documents that are left."""
    return digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("jaccard join", jaccard_join),
    ("decontamination", decontamination),
    ("bpe encoding", bpe_encoding),
]

# Learned models, minwise hashes and a public tokenizer are beyond SQL; tests/llm checks each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
