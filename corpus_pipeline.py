"""From documents to packed training sequences: five stages, each a written table."""

from pyspark.sql import DataFrame, SparkSession

from tempestry.llm import mixing, packing, quality, secret_scan, simhash
from tempestry.llm.common import read_table, ship
from tempestry.session import Scratch


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that weak supervision calls good."""
    ship(spark)
    return quality.good_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    ship(spark)
    return simhash.one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    ship(spark)
    return secret_scan.without_secrets(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids with their sequence and offset."""
    ship(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("source_mix", source_mix),
    ("sequence_packing", sequence_packing),
]

#: Expectation-maximisation, bit-wise trees and tokenizers are beyond SQL; the stages are
#: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and reread."""
    scratch = Scratch(spark)
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return scratch.save(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
