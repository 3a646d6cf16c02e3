"""Freshness: how long since each group last reported."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from cirrus.functions.expr import hours_crossed_sql, q
from cirrus.operators.aggregates import AggSpec, desc, run_spec


def _instant_sql(as_of: dt.datetime | str | None) -> str:
    if as_of is None:
        return "CAST(CURRENT_TIMESTAMP() AS TIMESTAMP_NTZ)"
    if isinstance(as_of, dt.datetime):
        return f"TIMESTAMP_NTZ'{as_of.isoformat(sep=' ')}'"
    return as_of  # SQL text


def freshness_spec(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    as_of: dt.datetime | str | None = None,
    delayed_hours: int = 6,
    stale_hours: int = 24,
    names: Sequence[str] = ("last_recorded_at", "total_records", "hours_since_last_record", "freshness_status"),
) -> AggSpec:
    last_a, count_a, hours_a, status_a = names
    mx = f"__max__{ts}"
    buffers = {mx: f"MAX({q(ts)})", "__rows": "COUNT(1)"}
    hours = hours_crossed_sql(q(mx), _instant_sql(as_of))
    status = (
        f"CASE WHEN {hours} > {stale_hours} THEN 'Stale' "
        f"WHEN {hours} > {delayed_hours} THEN 'Delayed' ELSE 'Fresh' END"
    )

    def finish(g: DataFrame) -> DataFrame:
        out = g.selectExpr(
            *[q(k) for k in keys],
            f"{q(mx)} AS {q(last_a)}",
            f"`__rows` AS {q(count_a)}",
            f"{hours} AS {q(hours_a)}",
            f"{status} AS {q(status_a)}",
        )
        return out.orderBy(*desc(hours_a))

    return AggSpec(tuple(keys), buffers, finish)


def freshness(df: DataFrame, keys: Sequence[str], ts: str, as_of: dt.datetime | str | None = None,
              delayed_hours: int = 6, stale_hours: int = 24, **kw) -> DataFrame:
    """Per group: newest ``ts``, row count, hour boundaries crossed from it to
    ``as_of``, and a status: > stale -> 'Stale', > delayed -> 'Delayed',
    otherwise (NULL included) 'Fresh'.

    ``as_of`` is a naive datetime, SQL text, or None for the current time
    (``current_timestamp``, fixed per query); pass a fixed instant for
    reproducible results.
    """
    return run_spec(df, freshness_spec(df, keys, ts, as_of, delayed_hours, stale_hours, **kw))
