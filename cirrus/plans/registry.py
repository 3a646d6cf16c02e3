"""Registered queries: name -> (Spark callable over a table folder, oracle SQL).

Every callable reads the given tables (through the derived readings views)
so its work grows with them; none runs on made-up input.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cirrus.functions.expr import lit, ntz, q
from cirrus.operators.freshness import freshness
from cirrus.operators.quality import CHECKS, quality_report, report_summary
from cirrus.plans import oracle as O
from cirrus.plans import rollup
from cirrus.plans import weather as W
from cirrus.plans.pipelines import analyse, validate
from cirrus.plans.suite import run_suite
from cirrus.session import ensure_checkpoint_dir
from cirrus.sinks.parquet_export import export, export_all, list_exports, read_export, run_stamp
from cirrus.sources.derived import dirty_readings, events_readings, load_table, orders_readings
from cirrus.sources.local import local_frame
from cirrus.sources.tables import append_or_create, conform, read_readings, replace_table
from cirrus.streaming.incremental import high_water_mark, incremental_load, incremental_run, newer_than

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed reference instant for freshness (the derived events end in January 2024).
FRESHNESS_AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)


def _events(fn: Callable[[DataFrame], DataFrame]) -> QueryFn:
    return lambda spark, sf_dir: fn(events_readings(spark, sf_dir))


def _orders(fn: Callable[[DataFrame], DataFrame]) -> QueryFn:
    return lambda spark, sf_dir: fn(orders_readings(spark, sf_dir))


def _weather_queries() -> dict[str, tuple[QueryFn, str | None]]:
    out: dict[str, tuple[QueryFn, str | None]] = {}
    for name, fn in W.QUERIES.items():
        if name == "data_freshness_per_city":
            fn = lambda r: W.data_freshness_per_city(r, FRESHNESS_AS_OF)
        if name == "monthly_temperature_trend":
            # The events view spans one month; the orders view spans 80.
            out[name] = (_orders(fn), O.query_sql(name, "O"))
        else:
            out[name] = (_events(fn), O.query_sql(name, "E"))
    return out


def _variant_queries() -> dict[str, tuple[QueryFn, str | None]]:
    """The same operators on other inputs, to reach branches the main views
    do not: per-user freshness on the raw events (by city every reading is
    recent), anomalies on the orders view (more outliers than the top-50
    cut, so tie-breaking matters), and an export read back."""
    def per_user(spark, sf_dir):
        return freshness(load_table(spark, sf_dir, "events"), ["user_id"], "ts", FRESHNESS_AS_OF)

    def export_read_back(spark, sf_dir):
        out = _table(spark, "export")
        path = export(W.avg_temperature_per_city(events_readings(spark, sf_dir)), "avg_temperature_per_city",
                      out, run_stamp())
        return read_export(spark, path)

    user_sql = f"""
WITH seen AS (SELECT user_id, max(ts) AS newest, count(*) AS n FROM events GROUP BY user_id),
aged AS (SELECT *, date_diff('hour', newest, {O.FRESHNESS_AS_OF_SQL}) AS age FROM seen)
SELECT user_id, newest AS last_recorded_at, n AS total_records, age AS hours_since_last_record,
       CASE WHEN age > 24 THEN 'Stale' WHEN age > 6 THEN 'Delayed' ELSE 'Fresh' END AS freshness_status
FROM aged"""
    return {
        "freshness_per_user": (per_user, user_sql),
        "anomaly_detection_orders": (_orders(W.anomaly_detection), O.query_sql("anomaly_detection", "O")),
        "export_read_back": (export_read_back, O.query_sql("avg_temperature_per_city", "E")),
    }


def registry() -> dict[str, tuple[QueryFn, str | None]]:
    out = _weather_queries()
    out.update(_variant_queries())
    out.update(_quality_queries())
    out.update(_load_queries())
    out.update(_suite_queries())
    return out


def _quality_queries() -> dict[str, tuple[QueryFn, str | None]]:
    def dirty_events(spark, sf_dir):
        return dirty_readings(events_readings(spark, sf_dir))

    def dirty_orders(spark, sf_dir):
        return dirty_readings(orders_readings(spark, sf_dir))

    out: dict[str, tuple[QueryFn, str | None]] = {
        "quality_report": (lambda s, d: quality_report(dirty_events(s, d)), O.report_sql("dirty", "E")),
        "quality_report_clean": (lambda s, d: quality_report(events_readings(s, d)), O.report_sql("readings", "E")),
        "quality_report_orders": (lambda s, d: quality_report(dirty_orders(s, d)), O.report_sql("dirty", "O")),
    }
    for name in CHECKS:
        out[f"check_{name}"] = (
            (lambda n: lambda s, d: quality_report(dirty_events(s, d), [n]))(name),
            O.report_sql("dirty", "E", [name]),
        )
    # Checks whose columns are not there.
    for name, gone in {
        "quality_report_without_measures": ("country", "humidity", "pressure", "wind_speed", "recorded_at"),
        "quality_report_without_temperature": ("temperature", "city"),
    }.items():
        out[name] = (
            (lambda g: lambda s, d: quality_report(dirty_events(s, d).drop(*g)))(gone),
            O.report_sql("dirty", "E", without=gone),
        )
    return out


# Stored part of the incremental examples: readings before this instant are
# "already loaded"; the rest of the source arrives incrementally.
INCREMENTAL_SPLIT = dt.datetime(2024, 1, 21, 0, 0, 0)
_SPLIT_SQL = "TIMESTAMP '2024-01-21 00:00:00'"


def _table(spark: SparkSession, kind: str) -> str:
    """A new table in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cirrus-tables/{kind}-{uuid.uuid4().hex}"


def _stored(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    """The readings; those before the split are stored at ``path``."""
    r = events_readings(spark, sf_dir)
    append_or_create(r.filter(F.col("recorded_at") < ntz(INCREMENTAL_SPLIT)), path)
    return r


def _load_queries() -> dict[str, tuple[QueryFn, str | None]]:
    def mark(spark, sf_dir):
        path = _table(spark, "mark")
        _stored(spark, sf_dir, path)
        kind = T.StructType([T.StructField("last_loaded", T.TimestampNTZType())])
        return local_frame(spark, [(high_water_mark(spark, path),)], kind)

    def load(spark, sf_dir):
        path = _table(spark, "load")
        r = _stored(spark, sf_dir, path)
        return incremental_load(r, high_water_mark(spark, path))

    def lazy_load(spark, sf_dir):
        path = _table(spark, "lazy")
        r = _stored(spark, sf_dir, path)
        return newer_than(r, read_readings(spark, path))

    def run_twice(spark, sf_dir):
        path = _table(spark, "run")
        r = _stored(spark, sf_dir, path)
        incremental_run(spark, r, path)
        return incremental_run(spark, r, path)

    def append(spark, sf_dir):
        path = _table(spark, "append")
        r = events_readings(spark, sf_dir)
        append_or_create(r.where("humidity < 50"), path, batch_id="low")
        append_or_create(r.where("humidity < 50"), path, batch_id="low")  # a repeated run
        append_or_create(r.where("false"), path)
        append_or_create(r.where("humidity >= 50").select(*reversed(r.columns)), path)
        return read_readings(spark, path)

    def replace(spark, sf_dir):
        path = _table(spark, "replace")
        append_or_create(events_readings(spark, sf_dir), path)
        replace_table(read_readings(spark, path).where("pressure > 1000"), path)
        return read_readings(spark, path)

    def exports(spark, sf_dir):
        out = _table(spark, "exports")
        r = events_readings(spark, sf_dir)
        export_all(
            {"gap": W.feels_like_gap(r), "none": W.feels_like_gap(r).where("false"), "hours": W.hourly_weather_pattern(r)}, out, "run1"
        )
        export_all({"gap": W.feels_like_gap(r)}, out, "run2")
        return list_exports(spark, out).select("query_name", "run_ts", F.col("rows").alias("row_count"))

    early = f"recorded_at < {_SPLIT_SQL}"
    newest = f"(SELECT max(recorded_at) FROM readings WHERE {early})"
    newer = O.with_fixture("E", f"SELECT * FROM readings WHERE recorded_at > {newest}")
    whole = O.with_fixture("E", "SELECT * FROM readings")
    listed = O.with_fixture("E", """
SELECT q.query_name, q.run_ts, q.row_count FROM (
  SELECT 'gap' AS query_name, 'run1' AS run_ts, count(DISTINCT city) AS row_count FROM readings
  UNION ALL SELECT 'gap', 'run2', count(DISTINCT city) FROM readings
  UNION ALL SELECT 'hours', 'run1', count(DISTINCT hour(recorded_at)) FROM readings) q""")
    return {
        "high_water_mark": (mark, O.with_fixture("E", f"SELECT {newest} AS last_loaded")),
        "incremental_load": (load, newer),
        "incremental_load_lazy": (lazy_load, newer),
        "incremental_run": (run_twice, whole),
        "append_or_create": (append, whole),
        "replace_table": (replace, O.with_fixture("E", "SELECT * FROM readings WHERE pressure > 1000")),
        "export_all_and_list": (exports, listed),
    }


def _cells(results: dict[str, DataFrame]) -> DataFrame:
    """Every value of all results: query_name, row_key, column_name, value."""
    out = None
    for name, df in results.items():
        kinds = dict(df.dtypes)
        keys = sorted(c for c, t in kinds.items() if t == "string" or t.startswith("timestamp"))
        shown = [f"coalesce({q(k)}, '')" if kinds[k] == "string" else f"coalesce(date_format({q(k)}, 'yyyy-MM-dd HH:mm:ss.SSSSSS'), '')"
                 for k in keys]
        cells = ", ".join(f"struct({lit(c)} AS column_name, CAST({q(c)} AS DOUBLE) AS value)" for c in sorted(kinds) if c not in keys)
        part = df.selectExpr(f"{lit(name)} AS query_name", f"concat_ws('|', {', '.join(shown) or lit('')}) AS row_key",
                             f"inline(array({cells}))")
        out = part if out is None else out.unionByName(part)
    return out


def _suite_queries() -> dict[str, tuple[QueryFn, str | None]]:
    def suite(spark, sf_dir):
        results, _ = run_suite(events_readings(spark, sf_dir), as_of=FRESHNESS_AS_OF)
        return _cells(results)

    def analysis(spark, sf_dir):
        run = analyse(spark, events_readings(spark, sf_dir), as_of=FRESHNESS_AS_OF)
        return _cells(run.results)

    def stored_rollup(spark, sf_dir):
        readings, store = _table(spark, "readings"), _table(spark, "rollup")
        r = _stored(spark, sf_dir, readings)
        rollup.refresh(spark, readings, store)
        incremental_run(spark, r, readings)
        rollup.refresh(spark, readings, store)
        return _cells(rollup.results(spark, readings, store, FRESHNESS_AS_OF))

    def summary(spark, sf_dir):
        s = report_summary(quality_report(dirty_readings(events_readings(spark, sf_dir))))
        return s.withColumn("failed_checks", F.concat_ws(",", "failed_checks"))

    def validation(spark, sf_dir):
        return validate(conform(events_readings(spark, sf_dir)))[0]

    summary_sql = (
        "SELECT bool_and(passed) AS passed, CAST(COUNT(*) FILTER (WHERE passed) AS BIGINT) AS passed_checks, "
        "CAST(COUNT(*) AS BIGINT) AS total_checks, "
        "CAST(COUNT(*) FILTER (WHERE passed) AS VARCHAR) || '/' || CAST(COUNT(*) AS VARCHAR) || ' checks passed' "
        "AS summary, string_agg(CASE WHEN NOT passed THEN check_name END, ',' ORDER BY check_order) "
        f"AS failed_checks FROM ({O.report_sql('dirty', 'E')}) rep"
    )
    return {
        "run_suite": (suite, O.cells_sql("E")),
        "analyse_pipeline": (analysis, O.cells_sql("E")),
        "stored_rollup": (stored_rollup, O.cells_sql("E")),
        "quality_summary": (summary, summary_sql),
        "validate_pipeline": (validation, O.report_sql("readings", "E")),
    }
