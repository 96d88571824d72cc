"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. Stages work on whatever their predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from opinio.llm import decontaminate, ngram_join, packing, quality, secrets
from opinio.llm.common import materialise, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    counted = materialise(quality.count_table(docs, "doc_id", "text"), "quality")
    return quality.keep_good(docs, quality.fit(counted, table(spark, sf_dir, "labels")))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies (and every text without words)."""
    return ngram_join.deduplicate(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents; the secrets in their texts are replaced and ``n_chars`` renewed."""
    return secrets.redact(docs, secrets.infer(materialise(secrets.scan(docs), "secrets")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences, each with its token ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", good_quality), ("near_duplicates", distinct_texts), ("decontaminate", uncontaminated),
          ("secrets", without_secrets), ("packing", packed)]

#: A fitted classifier and inferred grammars decide: SQL cannot express that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
