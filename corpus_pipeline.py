"""Corpus pipeline: quality filter, line dedup, near-dedup, PII, packing.

Each stage takes the documents that the stage before it kept, and its decisions
take effect: rejected documents go, dropped lines are missing from the texts,
one document of each near-duplicate group stays, personal data are replaced.
All but the last stage return the columns of ``documents``; each result is
written as Parquet in the shared folder and read again by the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake.llm import line_dedup, near_dups, packing, pii, quality
from paylake.llm.common import read, ship, write_shared


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier (10): documents that it rejects go."""
    return quality.keep(docs, read(spark, sf_dir, "labels"))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup (1): lines that five documents or more hold stay in one."""
    ship(spark)
    return line_dedup.without_common_lines(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup (9): one document of each group stays."""
    ship(spark)
    return near_dups.keep_one(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII (3): spans are replaced by their kind."""
    ship(spark)
    return pii.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing (7): the pieces of every document that is left."""
    ship(spark)
    return packing.digest(packing.pack(docs))


STAGES = [
    ("quality", filter_quality),
    ("line dedup", drop_common_lines),
    ("near-dedup", keep_one_of_each),
    ("pii", replace_personal_data),
    ("packing", pack_sequences),
]

#: Models, hash sketches and a tokenizer are beyond SQL; tests/llm/test_pipeline.py
#: holds the rows against a plain version of each stage.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
