"""The training-corpus pipeline: filter, near-duplicates, repeated passages, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one before kept. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewater.llm import packing, pii, rules, shared, simhash, suffix
from tidewater.llm.queries import table, tokenizer_path
from tidewater.llm.shared import forget, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the rules are learned from this stage's own documents and the labels."""
    return rules.keep(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return simhash.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that earlier documents hold."""
    return suffix.without_repeats(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    return pii.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' pieces in sequences of 4096 tokens."""
    return packing.query(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeats),
    ("personal data", personal_data),
    ("packing", pack),
]
# No SQL learns the rules or builds the packing: tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    with shared.run() as own:
        for name, stage in STAGES[:-1]:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
            forget(spark, own)  # what only earlier stages have read
        return STAGES[-1][1](spark, docs, sf_dir)
