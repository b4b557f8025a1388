"""The corpus pipeline: documents in, packed training sequences out, stage by stage.

Defined results: documents without words (null, empty, symbols only) are rejected by the first stage, as are those that its
rules drop; repeated rows and near copies leave one document, that with the smallest id, a null id last; very long texts pass
whole; other columns, of any name, are kept up to packing, which returns its own. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapelake.llm import decontaminate, near_duplicates, packing, personal_data, quality_rules
from tapelake.llm.common import table, written
from tapelake.llm.queries import tokenizer


def cleaned(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without the lines that fail them."""
    return quality_rules.clean(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return near_duplicates.keep_first(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of benchmark items."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return personal_data.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences, with their token ids."""
    # Workers that wait beside other stages hold no words.
    return packing.pack(docs, tokenizer("word_bpe_49k.json"), cached_words=200_000, keep_words=False)


STAGES = [
    ("quality rules", cleaned),
    ("near duplicates", deduplicated),
    ("decontamination", decontaminated),
    ("personal data", redacted),
    ("packing", packed),
]

# Tokenising and drawing signatures cannot be said in SQL; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, "stage")
    return docs
