"""Run the named queries as a suite with per-query status."""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cirrus.operators.aggregates import AggSpec, run_spec
from cirrus.plans.weather import QUERIES, data_freshness_per_city, fused_queries
from cirrus.session import ensure_checkpoint_dir
from cirrus.sources.local import local_frame

log = logging.getLogger(__name__)

R = TypeVar("R")

STATUS_SCHEMA = T.StructType(
    [
        T.StructField("query_name", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("row_count", T.LongType(), True),
        T.StructField("seconds", T.DoubleType(), True),
    ]
)


def run_concurrently(actions: Mapping[str, Callable[[], R]], parallelism: int | None = None) -> dict[str, R | Exception]:
    """Run independent Spark actions from a few driver threads.

    Spark schedules jobs from different threads side by side, so small jobs
    (the suite's results are aggregates) no longer wait for each other.
    Each outcome is kept per name: a value, or the exception it raised.
    """
    if not actions:
        return {}

    def guarded(fn):
        try:
            return fn()
        except Exception as e:  # noqa: BLE001 - reported per action
            return e

    workers = max(1, min(len(actions), parallelism or 8))
    with ThreadPoolExecutor(workers, thread_name_prefix="cirrus-suite") as ex:
        return dict(zip(actions, ex.map(guarded, actions.values())))


def run_suite(
    readings: DataFrame,
    queries: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
    fused: bool = True,
    as_of: dt.datetime | str | None = None,
    parallelism: int | None = None,
    extra: dict[str, AggSpec] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Run every query with a status each (suite order).

    ``fused`` (the default, for the sixteen named queries): all aggregate
    queries share one GROUPING SETS scan of ``readings``, checkpointed, and
    the anomaly query one more scan (see ``weather.fused_queries``).  The
    returned results are lazy frames over the checkpointed aggregate, cheap
    to show or export; their row counts are taken concurrently.  If the
    shared pass fails, every query is run on its own so that one bad query
    cannot fail the others.

    Otherwise each query is run on its own, concurrently, into the checkpoint
    folder.  Nothing is cached, so a later run reads its input again.  A failing query - at plan or at run time; Spark
    errors surface at the action, so the action is inside the guard - gets
    status 'failed' and no result.

    ``extra`` specs share the fused pass (the analysis passes the quality
    report this way); their lazy results are returned under their names,
    or run on their own when the suite is not fused.
    """
    spark = readings.sparkSession
    named = queries is None
    if named:
        queries = dict(QUERIES)
        queries["data_freshness_per_city"] = lambda r: data_freshness_per_city(r, as_of)
    built: dict[str, DataFrame] | None = None
    if named and fused:
        try:
            built, _ = fused_queries(readings, as_of, extra=extra)
        except Exception as e:  # noqa: BLE001 - fall back to one query at a time
            log.error("fused suite failed (%s); running queries one by one", e)

    def action(name: str, fn: Callable[[DataFrame], DataFrame]):
        def run():
            t0 = time.perf_counter()
            if built is not None:
                df = built[name]
            else:
                ensure_checkpoint_dir(spark)
                df = fn(readings).checkpoint(eager=True)
            return df, df.count(), time.perf_counter() - t0

        return run

    actions = {n: action(n, f) for n, f in queries.items()}
    extras = dict(extra or {})
    if built is not None:
        # Extras (e.g. the quality report) materialise alongside the results.
        def materialise(df: DataFrame):
            return df.checkpoint(eager=True), None, None

        for name in extras:
            actions[name] = (lambda d=built[name]: materialise(d))
    outcomes = run_concurrently(actions, parallelism)
    results: dict[str, DataFrame] = {}
    status = []
    for name in queries:
        out = outcomes[name]
        if isinstance(out, Exception):
            log.error("query %r failed: %s", name, out)
            status.append((name, "failed", None, None))
        else:
            df, n, secs = out
            results[name] = df
            status.append((name, "ok", n, secs))
    for name, spec in extras.items():
        out = outcomes.get(name)
        if isinstance(out, tuple):
            results[name] = out[0]
        else:
            results[name] = run_spec(readings, spec)
    return results, local_frame(spark, status, STATUS_SCHEMA)
