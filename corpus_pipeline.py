"""From raw documents to encoded training documents: quality rules, near-duplicates, decontamination, piece ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelattice.llm import decontamination, neardup, piece_lattice, rule_ledger
from carelattice.runtime import cut_lineage

#: The last stage encodes with a given vocabulary, which SQL cannot express; tests/llm compares run() with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of the rule ledger; a null text has no words and fails it."""
    return rule_ledger.keep_passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest doc_id, of every near-duplicate class; rows without doc_id stay."""
    return neardup.keep_one_per_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, verbatim or re-parameterised."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with piece_ids and round_trip."""
    return piece_lattice.encode(docs, piece_lattice.public_pieces())


STAGES = [("quality_rules", quality), ("near_duplicates", near_duplicates), ("decontamination", decontaminate), ("sentencepiece", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each but the last is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
