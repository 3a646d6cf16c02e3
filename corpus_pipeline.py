"""Training corpus pipeline: quality, near-dedup, decontamination, mixing, sharding.

Each stage is written as Parquet and read again as the next one's documents.
All but the last return the columns of ``documents``; the last adds curve,
shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus.llm import decontam, gam, hilbert, mixing, order_minhash
from cirrus.llm.common import cut_wide, read_table

# A classifier decides, so SQL cannot give the rows; tests compare with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model does not reject (score >= 0.3)."""
    model = gam.train(docs, read_table(spark, sf_dir, "labels"))
    kept = gam.score(docs, model, to="__score").where(F.col("__score") >= gam.THRESHOLD)
    return kept.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that of the least id."""
    return order_minhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an exact occurrence of a benchmark window."""
    return decontam.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated as often as they are taken."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with curve, shard and slot."""
    return hilbert.sharded_documents(docs)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_wide(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
