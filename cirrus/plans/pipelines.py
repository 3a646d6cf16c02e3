"""End-to-end flows: load -> check -> analyse -> (export), and load -> check."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cirrus.operators.quality import quality_report, quality_spec, report_summary
from cirrus.plans.suite import run_suite
from cirrus.session import ensure_checkpoint_dir
from cirrus.sinks.parquet_export import export_all
from cirrus.sources.jdbc import jdbc_full_load, jdbc_incremental_load
from cirrus.sources.sample import generate_readings
from cirrus.sources.tables import conform, read_readings
from cirrus.streaming.incremental import high_water_mark, incremental_run

log = logging.getLogger(__name__)

_REPORT = "__quality_report"


@dataclass
class AnalysisRun:
    report: DataFrame
    summary: DataFrame
    results: dict[str, DataFrame]
    status: DataFrame
    exported: dict[str, str] = field(default_factory=dict)


def load_readings(
    spark: SparkSession,
    mode: str,
    *,
    path: str | None = None,
    url: str | None = None,
    table: str = "weather_data",
    target: str | None = None,
    properties: dict[str, str] | None = None,
    day_partition: str | None = None,
    **sample_kw,
) -> DataFrame:
    """The readings an analysis starts from.

    mode 'sample': generated readings (``generate_readings(**sample_kw)``);
    'parquet': a stored table at ``path``; 'full': the whole JDBC ``table``;
    'incremental': JDBC rows newer than ``target``'s high-water mark are
    appended to ``target`` (optionally partitioned by day, see
    ``append_or_create``) and the whole stored table is returned.
    """
    if mode == "sample":
        return generate_readings(spark, **sample_kw)
    if mode == "parquet":
        return read_readings(spark, path)
    if mode == "full":
        return jdbc_full_load(spark, url, table, properties=properties)
    if mode == "incremental":
        mark = high_water_mark(spark, target, day_partition=day_partition)
        source = jdbc_incremental_load(spark, url, mark, table, properties=properties)
        return incremental_run(spark, source, target, day_partition=day_partition, mark=mark)
    raise ValueError(f"unknown mode {mode!r}")


def validate(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quality report and its one-row summary; nothing is stored."""
    ensure_checkpoint_dir(readings.sparkSession)
    report = quality_report(readings).checkpoint(eager=True)  # a row per check
    return report, report_summary(report)


def analyse(
    spark: SparkSession,
    readings: DataFrame,
    export_dir: str | None = None,
    run_ts: str | None = None,
    strict: bool = False,
    as_of=None,
    fused: bool = True,
) -> AnalysisRun:
    """Check the readings, run the query suite, optionally export.

    Failed checks are logged and, unless ``strict``, do not stop the run.
    When fused (and not strict) the value checks ride along in the suite's
    grouping-sets pass, so the whole analysis reads the readings three times:
    that pass, the duplicate check and the anomaly join.  ``strict`` checks
    first and stops before any query runs.
    """
    readings = conform(readings)
    if fused and not strict:
        results, status = run_suite(readings, fused=True, as_of=as_of, extra={_REPORT: quality_spec(readings)})
        report = results.pop(_REPORT)
        summary = report_summary(report)
    else:
        report, summary = validate(readings)
    s = summary.first()
    log.info("data quality: %s", s["summary"])
    if not s["passed"]:
        log.warning("failed checks: %s", ", ".join(s["failed_checks"]))
        if strict:
            raise ValueError(f"quality checks failed: {s['failed_checks']}")
    if not (fused and not strict):
        results, status = run_suite(readings, fused=fused, as_of=as_of)
    exported = export_all(results, export_dir, run_ts) if export_dir else {}
    return AnalysisRun(report, summary, results, status, exported)
