"""Queries over the test tables, one for each operator, and their SQL where it exists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.llm import byte_bpe, chat_rotation, conversation_repair, decontaminate, hard_negatives, html_wrapper, license_rules, mix_threshold, quality_jsd, simhash_trie, token_pfor, toxicity_mil, url_redirects
from rankfold.llm.common import table


def op1_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_mil.fit(docs, table(spark, sf_dir, "labels"))
    out = toxicity_mil.toxicity(docs, model, threshold=0.7)
    return out.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))


def op2_quality_jsd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_jsd.quality(table(spark, sf_dir, "documents"))


def op3_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.page_text(table(spark, sf_dir, "pages"))


def op4_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_rules.licenses(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                                         threshold=0.8, shingle=5).drop("text_hash")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op6_token_pfor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_pfor.token_digest(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0)


def op8_url_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_redirects.url_filter(table(spark, sf_dir, "pages"), url_redirects.rules_from(spark, url_redirects.RULES))


def op7_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat_rotation.rotate(table(spark, sf_dir, "conversations"))
    return out.withColumn("mask", chat_rotation.mask_text("spans")).drop("spans")


def op9_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trie.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4).select(
        "doc_id", "fingerprint", "component_id")


def op10_mix_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_threshold.mixture(table(spark, sf_dir, "documents"), weights=(1, 2, 3), max_repeat=3).select(
        "doc_id", "size", "source_size", "target", "taken")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"), label, F.col("id") % 50 == 0)


QUERIES = {f.__name__: f for f in (
    op1_toxicity_mil, op2_quality_jsd, op3_html_wrapper, op4_license_rules, op5_decontaminate,
    op6_token_pfor, op7_chat_rotation, op8_url_redirects, op9_simhash_trie, op10_mix_threshold,
    op11_byte_bpe, op12_conversation_repair, op13_hard_negatives)}

# The others hold trained models, XXH64 or hundreds of patterns that SQL on plain
# tables cannot express; tests/llm compares them with brute-force versions.
ORACLE: dict[str, str] = {
    "op5_decontaminate": decontaminate.ORACLE_SQL,
    "op7_chat_rotation": chat_rotation.ORACLE_SQL,
    "op8_url_redirects": url_redirects.ORACLE_SQL,
    "op10_mix_threshold": mix_threshold.ORACLE_SQL,
    "op12_conversation_repair": conversation_repair.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
