"""The registered queries of this subpackage; the SQL of those that SQL can express is in ``oracles``."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapelake.llm import (
    chat_format,
    decontaminate,
    hard_negatives,
    html_extract,
    line_dedup,
    near_duplicates,
    packing,
    personal_data,
    quality_gam,
    quality_rules,
    runs,
    suffix_dedup,
    token_counts,
)
from tapelake.llm.common import sha256_hex, table
from tapelake.llm.oracles import ORACLE_SQL  # noqa: F401


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("cleaned")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.digest(table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    control = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.digest(rows.unionByName(control))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), with_ids=False).drop("ids")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.find(table(spark, sf_dir, "documents")).drop("kept")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.find(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_shingles", F.col("first").alias("kept"))


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def planted_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which of a document's ``n`` words stands at each place: a tenth of the documents repeat a stretch up to their end."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(table(spark, sf_dir, "documents"), edit=planted_order)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, relabelled=label)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", sha256_hex(F.coalesce("kept", F.lit(""))).alias("kept_sha256"))


QUERIES = {
    "op1_quality_gam": op1_quality_gam,
    "op2_quality_rules": op2_quality_rules,
    "op3_packing": op3_packing,
    "op4_personal_data": op4_personal_data,
    "op5_chat_format": op5_chat_format,
    "op6_decontaminate": op6_decontaminate,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_token_counts": op8_token_counts,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_html_extract": op10_html_extract,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_line_dedup": op13_line_dedup,
}
