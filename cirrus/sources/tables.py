"""Readings tables at rest: read, conform, create, append, replace, query.

A *target* is either a storage path (contains '/' or a URI scheme), kept as a
committed table, or a catalog table name.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cirrus.schema import READINGS_SCHEMA
from cirrus.sources import committed

log = logging.getLogger(__name__)


def is_path(target: str) -> bool:
    return "/" in target or ":" in target


def target_exists(spark: SparkSession, target: str) -> bool:
    """Whether there is a table: rows of a dead run that were never committed are none."""
    if not is_path(target):
        return spark.catalog.tableExists(target)
    if committed.is_committed_table(spark, target):
        return bool(committed.batches(spark, target))
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(target)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and not fs.exists(jvm.org.apache.hadoop.fs.Path(f"{target}/data"))


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """A committed table, any other Parquet folder, or a catalog table."""
    if not is_path(target):
        return spark.table(target)
    rows = committed.read(spark, target) if committed.is_committed_table(spark, target) else None
    return spark.read.parquet(target) if rows is None else rows


def conform(df: DataFrame, schema: T.StructType = READINGS_SCHEMA) -> DataFrame:
    """Cast known columns to the declared types (by name) and turn NaN into
    NULL in floating columns.  Unknown columns are kept; absent ones stay
    absent so the quality checks can report them."""
    fields = {f.name: f.dataType for f in schema.fields}
    out = []
    for c in df.columns:
        if c not in fields:
            out.append(F.col(c))
            continue
        t = fields[c]
        e = F.col(c).cast(t)
        if isinstance(t, (T.DoubleType, T.FloatType)):
            e = F.nanvl(e, F.lit(None).cast(t))
        out.append(e.alias(c))
    return df.select(*out)


def read_readings(spark: SparkSession, target: str) -> DataFrame:
    """A stored readings table, conformed to the declared schema."""
    return conform(read_target(spark, target))


def _ordered_like(df: DataFrame, spark: SparkSession, target: str) -> DataFrame:
    """Align ``df`` to the stored column order by name (never by position)."""
    stored = read_target(spark, target).columns
    if set(stored) == set(df.columns):
        return df.select(*stored)
    missing = [c for c in stored if c not in df.columns]
    extra = [c for c in df.columns if c not in stored]
    if missing or extra:
        raise ValueError(f"schema mismatch appending to {target}: missing {missing}, extra {extra}")
    return df.select(*stored)


def with_day(df: DataFrame, ts: str, day_column: str) -> DataFrame:
    """Add the (naive) calendar day of ``ts`` as ``day_column``."""
    return df if day_column in df.columns else df.withColumn(day_column, F.to_date(F.col(ts)))


def append_or_create(
    df: DataFrame,
    target: str,
    day_partition: str | None = None,
    ts: str = "recorded_at",
    batch_id: str | None = None,
) -> int:
    """Append ``df`` to ``target`` (by column name), creating it if absent.

    Never drops existing rows.  Returns the number of rows written, observed
    during the write itself (no separate counting job).  Appending nothing
    writes nothing and creates nothing.

    A path is a committed table (``sources.committed``): rows count once their
    batch is committed, and a ``batch_id`` that is there already is not added
    again, so a run that died can be repeated.  The batch's newest ``ts`` is
    noted beside it.  Catalog tables, and plain Parquet folders written by
    others, are appended to by Spark as they are, without that protection.

    ``day_partition`` stores the batch partitioned by the day of ``ts`` (a
    column of that name): readers filtering on time prune to the days they need.
    """
    spark = df.sparkSession
    if day_partition:
        df = with_day(df, ts, day_partition)
    exists = target_exists(spark, target)
    plain = exists and is_path(target) and not committed.is_committed_table(spark, target)
    if is_path(target) and not plain:
        naive = dict(df.dtypes).get(ts) == "timestamp_ntz"
        rows = committed.append(df, target, batch_id, day_partition, ts if naive else None)
    elif df.isEmpty():
        rows = 0
    else:
        obs = Observation("append")
        data = _ordered_like(df, spark, target) if exists else df
        w = data.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append")
        if day_partition:
            w = w.partitionBy(day_partition)
        if plain:
            w.parquet(target)
        else:
            w.saveAsTable(target)
        rows = int(obs.get.get("rows", 0))
    log.info("%s %d record(s) in %s", "appended" if exists else "created with", rows, target)
    return rows


def replace_table(df: DataFrame, target: str, batch_id: str | None = None) -> int:
    """Replace ``target`` with ``df``.

    At a path, readers see the old rows until the new ones are committed, and
    keep them if the write fails; ``df`` may read the target itself.  A plain
    Parquet folder written by others is refused: it has no log to switch."""
    spark = df.sparkSession
    if is_path(target):
        if target_exists(spark, target) and not committed.is_committed_table(spark, target):
            raise ValueError(f"{target} is not a committed table")
        naive = dict(df.dtypes).get("recorded_at") == "timestamp_ntz"
        return committed.replace(df, target, batch_id, "recorded_at" if naive else None)
    obs = Observation("replace")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").saveAsTable(target)
    return int(obs.get.get("rows", 0))


def run_sql(
    spark: SparkSession,
    query: str,
    views: dict[str, DataFrame] | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """Run a SQL string over the given frames (registered as temp views).

    Lazy: time and row count belong to whatever action consumes the result.
    With an ``observation``, that action also records the row count
    (``observation.get["rows"]``) without a second job.
    """
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    out = spark.sql(query)
    return out.observe(observation, F.count(F.lit(1)).alias("rows")) if observation is not None else out
