"""The corpus pipeline: four stages from raw documents to packed training sequences.

Each stage takes the documents that its predecessor kept, as they were
written, and all but the last return the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import langid, packing, simhash, toxicity
from matchlake.llm.common import read_table, save, ship_package


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold; labels teach the score."""
    ship_package(spark)
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised above the calibrated rejection level."""
    ship_package(spark)
    return langid.keep_recognised(docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near-duplicates."""
    ship_package(spark)
    return simhash.deduplicate(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the kept documents with their sequences and offsets."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [("toxicity", remove_toxic), ("language_id", keep_known_languages),
          ("simhash_dedup", remove_near_duplicates), ("best_fit_packing", pack_sequences)]

# SQL expresses neither the trained stages nor the packing; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
