"""Registered queries of the corpus operators: each one whole table, whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paylake.llm import (ann, bpe, fingerprints, lexical, line_dedup, near_dups, packing, pii, quality, simhash,
                         substrings, toxicity, vector_codes)
from paylake.llm.common import read


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(line_dedup.dedup(read(spark, sf_dir, "documents")))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(read(spark, sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.dedup(read(spark, sf_dir, "documents")))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(read(spark, sf_dir, "documents")))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(read(spark, sf_dir, "documents"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.link(read(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.digest(*vector_codes.compress(read(spark, sf_dir, "embeddings")))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(simhash.link(read(spark, sf_dir, "documents")))


REGISTRY = {f.__name__: f for f in (
    op1_line_dedup, op2_bpe, op3_pii, op4_toxicity, op5_ann, op6_substring_dedup, op7_packing, op8_fingerprints,
    op9_minhash, op10_quality, op11_vector_codes, op12_lexical_search, op13_simhash)}

#: DuckDB SQL of the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op1_line_dedup": line_dedup.ORACLE,
                              "op11_vector_codes": vector_codes.ORACLE,
                              "op12_lexical_search": lexical.ORACLE}
