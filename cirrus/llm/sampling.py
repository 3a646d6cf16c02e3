"""Bounded training samples: the only rows that reach the driver for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cirrus.llm.common import cut


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def held_out(doc_id: Column) -> Column:
    return fold(doc_id) == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, targets: list[str], max_rows: int) -> DataFrame:
    """Up to ``max_rows`` rows (doc_id, text, targets) that may be learnt from.

    Rows whose fold is 0 are never used.  The choice is by a hash of the id,
    the same on every run.  Labels with a null target or id are left out.  The
    chosen labels are at most ``max_rows`` small rows, so they are broadcast;
    texts that are not chosen are dropped in the scan.
    """
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    for t in targets:
        known = known.where(F.col(t).isNotNull())
    lab = known.select(F.col("doc_id").alias("__id"), *[F.col(t).cast("int").alias(f"__y_{t}") for t in targets])
    lab = cut(lab.orderBy(F.xxhash64("__id"), "__id").limit(max_rows))
    chosen = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(lab), F.col("doc_id") == F.col("__id")
    )
    return chosen.select("doc_id", "text", *[F.col(f"__y_{t}").alias(t) for t in targets])
