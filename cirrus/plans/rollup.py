"""Stored roll-up: the suite's partial results, refreshed from new rows only.

Beside a committed table of readings stands a second committed table with, for
each batch taken in, the buffers of every group of every grouping set (counts,
least, greatest, exact sums) and the most extreme readings of each city.  Both
merge: the sixteen results of all rows follow from the stored parts, whose size
is that of the results times the batches, and a refresh reads the batches that
were not taken in yet, nothing else.
"""

from __future__ import annotations

import datetime as dt
import json
import logging

from pyspark.sql import DataFrame, SparkSession

from cirrus import schema as S
from cirrus.operators.aggregates import SetPlan, plan_sets
from cirrus.operators.outliers import extremes, group_moments_spec, outliers_of_extremes
from cirrus.plans import weather as W
from cirrus.session import ensure_checkpoint_dir
from cirrus.sources import committed
from cirrus.sources.local import empty_frame
from cirrus.sources.tables import conform

log = logging.getLogger(__name__)

KEEP = 200  # readings kept at either end of a city's temperatures, four times the report's length
GROUPS, ENDS = "groups", "ends"
_MOMENTS = "__city_moments"


def _plan(spark: SparkSession, as_of: dt.datetime | str | None = None) -> SetPlan:
    readings = empty_frame(spark, S.READINGS_SCHEMA)
    specs = {name: build(readings) for name, build in W._specs(as_of, fused=True).items()}
    return plan_sets({**specs, _MOMENTS: group_moments_spec(readings, [S.CITY], S.TEMPERATURE)})


def _taken(parts: list[committed.Batch]) -> set[str]:
    return {i for p in parts for i in json.loads(p.info["sources"])}


def refresh(spark: SparkSession, readings: str, rollup: str) -> int:
    """Take the batches of ``readings`` into ``rollup`` that it lacks; how many.

    One pass over those batches.  The part is committed under the ids of its
    batches, so a refresh that dies is repeated without counting a row twice.
    If ``readings`` was replaced meanwhile, the roll-up starts anew."""
    stored = committed.batches(spark, readings)
    taken = _taken(committed.batches(spark, rollup))
    anew = bool(taken - {b.batch_id for b in stored})
    new = [b for b in stored if anew or b.batch_id not in taken]
    if not new:
        return 0
    rows = conform(committed.read_batches(spark, readings, new))
    parts = {
        GROUPS: _plan(spark).aggregate(rows),
        ENDS: extremes(rows, [S.CITY], S.TEMPERATURE, S.RECORDED_AT, KEEP),
    }
    ids = json.dumps([b.batch_id for b in new])
    committed.commit_parts(spark, rollup, ids, parts, replaces=anew, info={"sources": ids})
    log.info("took %d batch(es) of %s into %s", len(new), readings, rollup)
    return len(new)


def compact(spark: SparkSession, rollup: str) -> int:
    """Merge all parts into one; how many there were."""
    parts = committed.batches(spark, rollup)
    if len(parts) > 1:
        ids = json.dumps(sorted(_taken(parts)))
        merged = {
            GROUPS: _plan(spark).merge(committed.read_batches(spark, rollup, parts, GROUPS)),
            ENDS: extremes(committed.read_batches(spark, rollup, parts, ENDS), [S.CITY], S.TEMPERATURE, S.RECORDED_AT, KEEP),
        }
        committed.commit_parts(spark, rollup, f"compact {ids}", merged, replaces=True, info={"sources": ids})
    return len(parts)


def results(
    spark: SparkSession, readings: str, rollup: str, as_of: dt.datetime | str | None = None, std_threshold: float = 2.0
) -> dict[str, DataFrame]:
    """The sixteen results of the rows taken in so far, in suite order.

    Lazy frames over the merged groups (checkpointed: as many rows as the
    results together).  The anomalies come from the kept readings if these
    settle them; if not (more than KEEP readings of a city beyond what the
    report shows), the stored readings are read again."""
    parts = committed.batches(spark, rollup)
    if not parts:
        raise ValueError(f"{rollup} is empty: refresh it first")
    ensure_checkpoint_dir(spark)
    plan = _plan(spark, as_of)
    groups = plan.merge(committed.read_batches(spark, rollup, parts, GROUPS)).checkpoint(eager=True)
    out = plan.finish(groups)
    moments = out.pop(_MOMENTS)
    ends = extremes(committed.read_batches(spark, rollup, parts, ENDS), [S.CITY], S.TEMPERATURE, S.RECORDED_AT, KEEP)
    found = outliers_of_extremes(ends.checkpoint(eager=True), moments, [S.CITY], S.TEMPERATURE, S.RECORDED_AT, KEEP, std_threshold, 50)
    if found is None:
        log.info("more extreme readings than are kept: reading %s", readings)
        taken = _taken(parts)
        some = [b for b in committed.batches(spark, readings) if b.batch_id in taken]
        found = W.anomaly_detection(conform(committed.read_batches(spark, readings, some)), std_threshold, moments=moments)
    out["anomaly_detection"] = found
    return {name: out[name] for name in W.QUERIES}
