"""Helpers the text operators share: words, lineage cuts, sized joins, ranks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cirrus.session import ensure_checkpoint_dir

WORD_GAP = r"[\x20\x09-\x0D]+"
# A side is broadcast only when it is measured to be at most this large.
BROADCAST_BYTES = 16 * 1024 * 1024
_LOW33 = (1 << 33) - 1


def words(text: Column) -> Column:
    """Array of the runs of anything but space, \\t, \\n, \\v, \\f and \\r; empty for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


# pandas turns integer columns that hold a null into floats, so ids travel
# through pandas workers as text.
def id_text(doc_id: str = "doc_id") -> Column:
    return F.col(doc_id).cast("string").alias(doc_id)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of narrow rows in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_wide(df: DataFrame) -> DataFrame:
    """As :func:`cut` for rows that carry texts: a compressed Parquet table in
    the shared checkpoint folder (a checkpoint would store them uncompressed)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Step:
    """A table that the steps of a loop replace: Parquet in the shared folder.

    Once a step is written, the table before it is removed: what is written is
    read from its own files only, so nothing refers to the old ones.  Small
    files are read together, however many partitions wrote them."""

    def __init__(self, df: DataFrame):
        self.path = None
        self.put(df)

    def put(self, df: DataFrame) -> None:
        spark, old = df.sparkSession, self.path
        self.path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
        df.write.parquet(self.path)
        self.rows = spark.read.schema(df.schema).parquet(self.path)
        if old:
            _remove(spark, old)

    def drop(self) -> None:
        _remove(self.rows.sparkSession, self.path)


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def sized(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (already cut) marked for broadcast if its counted rows, at
    ``row_bytes`` each, are within ``limit``; otherwise unchanged, so the join
    shuffles and adaptive execution splits its skewed partitions."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def text_key(text: Column) -> Column:
    """128-bit key of a text; null counts as the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def ranked(
    df: DataFrame,
    order: Sequence[Column],
    group: Sequence[str] = (),
    rank: str = "rank",
    wide: bool = False,
    totals: Mapping[str, Column] | None = None,
    per_group: DataFrame | None = None,
) -> DataFrame:
    """Add ``rank``: the 0-based position of each row in ``order`` within its
    group, without gathering a group (or everything) in one task.

    ``order`` must begin with the group columns and should end with a hash, so
    that equal rows spread over ranges.  One range shuffle, sorted inside each
    range and cut; the row's place in its range comes from the row counter of
    that same stage.  A summary of one row per (range, group) gives each range
    its start.  It holds at most (ranges + groups) rows and is broadcast only
    after a count.  ``totals`` adds sums over the rows before this one (in the
    same order); ``per_group`` adds columns by group (one row for each group).
    """
    pid, pos = "__pid", "__pos"
    spread = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(pid, F.spark_partition_id())
        .withColumn(pos, F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33)))
    )
    spread = cut_wide(spread) if wide else cut(spread)
    sums = dict(totals or {})
    parts = spread.groupBy(pid, *group).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min(pos).alias("__first"),
        *[F.sum(c).alias(f"__t_{a}") for a, c in sums.items()],
    )
    before = Window.partitionBy(*group).orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        pid,
        *group,
        "__first",
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"),
        *[F.coalesce(F.sum(f"__t_{a}").over(before), F.lit(0)).alias(f"__t_{a}") for a in sums],
    )
    if per_group is not None:
        on = [f"__g_{g}" for g in group]
        per_group = per_group.withColumnsRenamed(dict(zip(group, on)))
        same = [parts[g].eqNullSafe(per_group[o]) for g, o in zip(group, on)]
        parts = parts.join(per_group, same, "left").drop(*on)
    parts = cut(parts)
    keys = [pid, *group]
    other = [f"__o_{k}" for k in keys]
    small = sized(parts.withColumnsRenamed(dict(zip(keys, other))), 64 + 16 * len(parts.columns))
    out = spread.join(small, [spread[k].eqNullSafe(small[o]) for k, o in zip(keys, other)], "left").drop(*other)
    out = out.withColumn(rank, F.col("__start") + F.col(pos) - F.col("__first"))
    if sums:
        local = Window.partitionBy(pid, *group).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
        for a, c in sums.items():
            out = out.withColumn(a, F.col(f"__t_{a}") + F.coalesce(F.sum(c).over(local), F.lit(0)))
    return out.drop(pid, pos, "__start", "__first", *[f"__t_{a}" for a in sums])
