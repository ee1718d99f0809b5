"""A corpus pipeline over ``documents``: toxicity, SimHash near-duplicates, benchmark
decontamination, mixing to source weights, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet to
the shared scratch folder and read again as the next stage's ``docs``. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rankfold.llm import decontaminate, mix_threshold, simhash_trie, token_pfor, toxicity_mil
from rankfold.llm.common import table, written
from rankfold.llm.registry import tokenizer_path


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.7 stay."""
    return toxicity_mil.without_toxic(docs, toxicity_mil.fit(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: 4-word shingles, 4 bits."""
    return simhash_trie.one_per_group(docs, shingle=4, max_bits=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold 0.8 or more of the 5-word shingles of a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"), threshold=0.8, shingle=5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of source weights 1, 2, 3 takes it (0 to 3 times)."""
    return mix_threshold.mixed_rows(docs, weights=(1, 2, 3), max_repeat=3)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix and, read back from them, a digest for each document. The workers are
    those of the stages before, so the encoder remembers fewer chunks than alone."""
    return token_pfor.token_digest(docs, tokenizer_path(), end_id=0, memo=400_000)


STAGES = [("toxicity", toxicity), ("simhash near-dedup", simhash), ("benchmark decontamination", decontamination),
          ("mixing", mixing), ("token output", tokens)]

# The trained toxicity model and the tokenizer cannot be written in SQL; tests/llm compares
# every stage with a brute-force version on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
