"""The corpus pipeline: language, near duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again as the next stage's documents. All stages but the last keep the columns of
``documents`` (and any others); a stage works on all rows that its predecessor kept. Nulls,
empty texts, repeated rows and empty tables are treated as each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shopgrain.llm import decontamination, jaccard, language, packing, secrets
from shopgrain.llm.common import written
from shopgrain.llm.registry import table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is rejected go: null, empty and letterless texts, and narrow
    margins. The dictionaries are fitted on this stage's own documents that may be learned
    from; without any, no language can be told and every document goes."""
    return language.keep_accepted(docs, language.fit(language.training_rows(docs)))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id
    (nulls last); of repeated rows one stays. A document without words is its own group,
    also if it is repeated."""
    return jaccard.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; every document stays."""
    return secrets.mask_secrets(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("ngram_jaccard", duplicates_stage),
    ("decontamination", decontamination_stage),
    ("secret_scan", secrets_stage),
    ("best_fit_packing", packing_stage),
]

#: Compression, SimHash and tokenizers are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
