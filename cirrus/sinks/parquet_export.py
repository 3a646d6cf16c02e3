"""Parquet export of query results, with a manifest of what was written.

Layout: ``<out>/query_name=<q>/run_ts=<YYYYmmdd_HHMMSS>/part-*.snappy.parquet``
(real directory partitions, so ``spark.read.parquet(out)`` prunes by query
and run), plus ``<out>/_manifest`` (query_name, run_ts, path, rows).
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cirrus.sources import committed
from cirrus.sources.local import empty_frame, local_frame

log = logging.getLogger(__name__)

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("query_name", T.StringType(), False),
        T.StructField("run_ts", T.StringType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("rows", T.LongType(), False),
    ]
)


def run_stamp(now: dt.datetime | None = None) -> str:
    return (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")


def _fs_delete(spark: SparkSession, path: str) -> None:
    """Remove an export folder we just wrote, and its query folder if that is
    left empty."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(p, True)
    parent = p.getParent()
    if fs.exists(parent) and len(fs.listStatus(parent)) == 0:
        fs.delete(parent, False)


def _manifest(out_dir: str) -> str:
    return f"{out_dir.rstrip('/')}/_manifest"


def _write_manifest(spark: SparkSession, out_dir: str, entries: list[tuple[str, str, str, int]]) -> None:
    if entries:
        committed.append(local_frame(spark, entries, MANIFEST_SCHEMA), _manifest(out_dir))


def _export(df: DataFrame, query_name: str, out_dir: str, ts: str) -> tuple[str, int]:
    spark = df.sparkSession
    path = f"{out_dir.rstrip('/')}/query_name={query_name}/run_ts={ts}"
    obs = Observation(f"export_{query_name}")
    (
        df.observe(obs, F.count(F.lit(1)).alias("rows"))
        .write.mode("errorifexists")
        .option("compression", "snappy")
        .parquet(path)
    )
    rows = int(obs.get.get("rows", 0))
    if rows == 0:
        _fs_delete(spark, path)
        log.warning("skipping export for %r - result is empty", query_name)
        return "", 0
    log.info("exported %r to %s (%d rows)", query_name, path, rows)
    return path, rows


def export(df: DataFrame, query_name: str, out_dir: str, run_ts: str | None = None) -> str:
    """Write one result as Snappy Parquet and return its path.

    An empty result is skipped and "" returned; emptiness is the row count
    observed during the write itself (no second job over the query).  A
    repeated (query, run) pair fails instead of overwriting.  Errors are
    re-raised.
    """
    ts = run_ts or run_stamp()
    path, rows = _export(df, query_name, out_dir, ts)
    if path:
        _write_manifest(df.sparkSession, out_dir, [(query_name, ts, path, rows)])
    return path


def export_all(
    results: dict[str, DataFrame], out_dir: str, run_ts: str | None = None, parallelism: int | None = None
) -> dict[str, str]:
    """Export every result under one run stamp, writes running concurrently.

    A failed export is recorded as "" and does not stop the others; skipped
    (empty) results are absent from the returned map.
    """
    from cirrus.plans.suite import run_concurrently

    if not results:
        return {}
    ts = run_ts or run_stamp()
    outcomes = run_concurrently(
        {name: (lambda n=name, d=df: _export(d, n, out_dir, ts)) for name, df in results.items()}, parallelism
    )
    exported: dict[str, str] = {}
    entries = []
    for name in results:
        out = outcomes[name]
        if isinstance(out, Exception):
            log.error("export failed for %r: %s", name, out)
            exported[name] = ""
        elif out[0]:
            exported[name] = out[0]
            entries.append((name, ts, out[0], out[1]))
    # One batch of the manifest for the run; runs side by side each commit their own.
    _write_manifest(next(iter(results.values())).sparkSession, out_dir, entries)
    ok = sum(1 for p in exported.values() if p)
    log.info("export complete - %d/%d written", ok, len(results))
    return exported


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """Read an exported result back (schema from the Parquet footers)."""
    return spark.read.parquet(path)


def list_exports(spark: SparkSession, out_dir: str) -> DataFrame:
    """Manifest rows ordered by path; empty when nothing was exported."""
    rows = committed.read(spark, _manifest(out_dir))
    return empty_frame(spark, MANIFEST_SCHEMA) if rows is None else rows.orderBy("path")
