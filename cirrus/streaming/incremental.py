"""Incremental loading by high-water mark.

The stored table's newest event time is the mark; only source rows strictly
newer than it are loaded and appended.  Like any single global mark, this
never loads late rows (older than the mark) nor rows of other series that
share the mark's exact timestamp.

Two forms:
* driver-orchestrated (``high_water_mark`` -> ``incremental_load`` ->
  ``append_or_create`` -> re-read), for sources such as JDBC where the mark
  must be written into the remote query;
* lazy (``newer_than``), where the mark is a scalar subquery over the stored
  frame and is pushed into the source scan as a filter.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cirrus.functions.expr import ntz
from cirrus.schema import READINGS_SCHEMA, RECORDED_AT
from cirrus.sources import committed
from cirrus.sources.local import empty_frame
from cirrus.sources.tables import append_or_create, is_path, read_target, target_exists

log = logging.getLogger(__name__)

EARLIEST = "0001-01-01 00:00:00"


def _newest_day(spark: SparkSession, target: str, day_partition: str) -> str | None:
    """Newest ``day_partition=YYYY-MM-DD`` folder of a stored path (a listing
    of one entry per day, read on the driver; no data is scanned)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(target)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    prefix = f"{day_partition}="
    days = [s.getPath().getName()[len(prefix):] for s in fs.listStatus(root)
            if s.isDirectory() and s.getPath().getName().startswith(prefix)]
    days = [d for d in days if d != "__HIVE_DEFAULT_PARTITION__"]
    return max(days) if days else None


def high_water_mark(
    spark: SparkSession, target: str, ts: str = RECORDED_AT, day_partition: str | None = None
) -> dt.datetime | None:
    """Newest ``ts`` stored in ``target``; None when it is missing or empty.

    A committed table notes each batch's newest ``ts`` when it is written, so
    only its log is read, no row.  Otherwise one global aggregate (partial max
    per task, one row to the driver); for a day-partitioned plain folder only
    the newest day is read, found by a folder listing.
    """
    if not target_exists(spark, target):
        log.info("%s does not exist yet - full load required", target)
        return None
    if is_path(target) and committed.is_committed_table(spark, target):
        some = committed.batches(spark, target)
        noted = committed.greatest_of(some, ts)
        if noted is not None and all(f"greatest:{ts}" in b.info or not b.rows for b in some):
            return dt.datetime.fromisoformat(noted)
    stored = read_target(spark, target)
    if day_partition and is_path(target) and not committed.is_committed_table(spark, target):
        day = _newest_day(spark, target, day_partition)
        if day is not None:
            newest = stored.where(F.col(day_partition) == F.to_date(F.lit(day))).agg(F.max(ts)).first()[0]
            if newest is not None:
                return newest
    return stored.agg(F.max(ts)).first()[0]


def mark_of(stored: DataFrame, ts: str = RECORDED_AT) -> DataFrame:
    """One-row frame with the mark of a stored frame (column ``last_loaded``)."""
    return stored.agg(F.max(ts).alias("last_loaded"))


def incremental_load(source: DataFrame, mark: dt.datetime | None, ts: str = RECORDED_AT) -> DataFrame:
    """Source rows strictly newer than ``mark``; the whole source when None."""
    if mark is None:
        return source
    return source.filter(F.col(ts) > ntz(mark))


def newer_than(source: DataFrame, stored: DataFrame, ts: str = RECORDED_AT) -> DataFrame:
    """Lazy incremental load: source rows newer than ``max(stored.ts)``.

    The mark is a scalar subquery, so the comparison is pushed into the
    source scan's filters and no value passes through the driver.  An empty
    ``stored`` gives the earliest representable mark (everything with an
    event time is newer); rows without an event time are never newer.
    """
    mark = stored.agg(F.expr(f"COALESCE(MAX({ts}), TIMESTAMP_NTZ'{EARLIEST}')")).scalar()
    return source.filter(F.col(ts) > mark)


_LOOK = object()


def incremental_run(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    ts: str = RECORDED_AT,
    day_partition: str | None = None,
    mark: dt.datetime | None | object = _LOOK,
) -> DataFrame:
    """Mark -> load newer rows -> append -> the whole stored table.

    The batch is named after the mark it starts from.  A run that dies before
    its commit leaves the mark where it was and is simply repeated; one that
    dies after it has moved the mark, so repeating it finds nothing newer.
    ``mark`` saves looking it up where the caller has done so.  Returns an
    empty frame with the readings schema when neither the source nor the target
    holds anything.
    """
    if mark is _LOOK:
        mark = high_water_mark(spark, target, ts, day_partition)
    new_rows = incremental_load(source, mark, ts)
    batch_id = f"newer than {mark.isoformat()}" if mark is not None else "full load"
    n = append_or_create(new_rows, target, day_partition, ts, batch_id)
    log.info("loaded %d new record(s) since %s", n, mark)
    if target_exists(spark, target):
        return read_target(spark, target)
    return empty_frame(spark, READINGS_SCHEMA)
