"""Ranking and trend operators over per-group aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cirrus.functions.expr import lookup_sql, period_start_sql, q, round_sql
from cirrus.functions.moments import merged
from cirrus.operators.aggregates import AggSpec, Stat, asc, moments_of, raw_name, run_spec, stats_spec
from cirrus.operators.ranks import add_ranks


def rank_groups_spec(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    desc_alias: str = "hottest_rank",
    asc_alias: str = "coldest_rank",
) -> AggSpec:
    avg_a = f"avg_{value}"

    def then(g: DataFrame) -> DataFrame:
        ranked = add_ranks(g, [(raw_name(avg_a), True, desc_alias), (raw_name(avg_a), False, asc_alias)])
        out = ranked.select(*keys, avg_a, desc_alias, asc_alias)
        return out.orderBy(*asc(desc_alias))

    return stats_spec(df, keys, [Stat("avg", value, avg_a)], keep_raw=[avg_a], then=then, reread=True)


def rank_groups(df: DataFrame, keys: Sequence[str], value: str, **kw) -> DataFrame:
    """Per group: rounded mean, its rank highest-first and lowest-first.

    Ranks use the unrounded mean; output ordered by the descending rank.
    """
    return run_spec(df, rank_groups_spec(df, keys, value, **kw))


def volatility_rank_spec(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    count_alias: str = "total_readings",
    rank_alias: str = "volatility_rank",
) -> AggSpec:
    sd = f"{value}_stddev"
    stats = [
        Stat("stddev_pop", value, sd),
        Stat("avg", value, f"avg_{value}"),
        Stat("min", value, f"min_{value}"),
        Stat("max", value, f"max_{value}"),
        Stat("count", None, count_alias),
    ]
    shown = [*keys, *[s.alias for s in stats]]

    def then(g: DataFrame) -> DataFrame:
        out = add_ranks(g, [(raw_name(sd), True, rank_alias)]).select(*shown, rank_alias)
        return out.orderBy(*asc(rank_alias))

    return stats_spec(df, keys, stats, keep_raw=[sd], then=then, reread=True)


def volatility_rank(df: DataFrame, keys: Sequence[str], value: str, **kw) -> DataFrame:
    """Per group: population stddev, mean, min, max, count; ranked by stddev."""
    return run_spec(df, volatility_rank_spec(df, keys, value, **kw))


def mapped_rollup_rank_spec(
    df: DataFrame,
    key: str,
    mapping: Mapping[str, str],
    otherwise: str,
    value: str,
    rollup_alias: str,
    distinct_alias: str | None = None,
    count_alias: str = "total_readings",
    rank_alias: str = "temperature_rank",
    via_keys: Sequence[str] | None = None,
) -> AggSpec:
    """Two-level plan: aggregate by (rolled-up key, key), then re-aggregate
    by the rolled-up key.  ``via_keys`` (containing ``key``) groups by those
    keys instead and maps ``key`` in the finishing step, so a fused suite
    serves this query from an existing grouping set.  The distinct count of ``key`` is then a plain
    count of first-level groups (no Expand-based distinct aggregate), and the
    exact integer sums merge without error."""
    m = moments_of(df, value)
    mn, mx = f"__min__{value}", f"__max__{value}"
    buffers = {**m.mean_buffers(), mn: f"MIN({q(value)})", mx: f"MAX({q(value)})", "__rows": "COUNT(1)"}
    avg_a = f"avg_{value}"
    distinct_alias = distinct_alias or f"{key}_count"
    merge = [F.expr(f"{merged(b, t)} AS {q(b)}") for b, t in buffers.items()]

    def mm(c: str) -> str:
        return round_sql(c, 2) if m.fractional else c

    def finish(g: DataFrame) -> DataFrame:
        if via_keys:
            g = g.selectExpr(f"{lookup_sql(q(key), mapping, otherwise)} AS {q(rollup_alias)}", q(key),
                             *[q(b) for b in buffers])
            g = g.groupBy(rollup_alias, key).agg(*merge)
        r = g.groupBy(rollup_alias).agg(*merge, F.expr(f"COUNT({q(key)}) AS {q(distinct_alias)}"))
        out = r.selectExpr(
            q(rollup_alias),
            f"{round_sql(m.mean(), 2)} AS {q(avg_a)}",
            f"{mm(q(mn))} AS {q('min_' + value)}",
            f"{mm(q(mx))} AS {q('max_' + value)}",
            q(distinct_alias),
            f"`__rows` AS {q(count_alias)}",
            f"{m.mean()} AS __rank_value",
        )
        out = add_ranks(out, [("__rank_value", True, rank_alias)]).drop("__rank_value")
        return out.orderBy(*asc(rank_alias))

    if via_keys:
        return AggSpec(tuple(via_keys), buffers, finish, m.mean_derived())
    rolled = {rollup_alias: lookup_sql(q(key), mapping, otherwise)}
    return AggSpec((rollup_alias, key), buffers, finish, {**m.mean_derived(), **rolled}, reread=True)


def mapped_rollup_rank(df: DataFrame, key: str, mapping: Mapping[str, str], otherwise: str, value: str,
                       rollup_alias: str, **kw) -> DataFrame:
    """Roll ``key`` up through ``mapping`` and rank the rolled-up groups.

    The map is a fixed literal expression (no join).  Per rolled-up group:
    mean, min, max of ``value``, distinct ``key`` count, row count and the
    rank of the unrounded mean, highest first.
    """
    return run_spec(df, mapped_rollup_rank_spec(df, key, mapping, otherwise, value, rollup_alias, **kw))


def period_over_period_spec(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    period: str,
    value: str,
    period_alias: str = "month",
    change_alias: str = "change_from_previous_month",
    via_day: str | None = None,
) -> AggSpec:
    """``via_day`` (a column name): group by (keys, day of ``ts``) and roll the
    exact sums up to the period in the finishing step, so a fused suite
    serves this query from the same grouping set as its daily profiles."""
    avg_a = f"avg_{value}"
    raw = q(raw_name(avg_a))
    part = ", ".join(q(k) for k in keys)
    if via_day:
        return _period_over_period_via_day(df, keys, ts, period, value, period_alias, change_alias, via_day)

    def then(g: DataFrame) -> DataFrame:
        lag = f"LAG({raw}, 1) OVER (PARTITION BY {part} ORDER BY {q(period_alias)} ASC NULLS LAST)"
        out = g.selectExpr(
            *[q(k) for k in keys], q(period_alias), q(avg_a), f"{round_sql(f'{raw} - {lag}', 2)} AS {q(change_alias)}"
        )
        return out.orderBy(*asc(*keys, period_alias))

    return stats_spec(
        df,
        [*keys, period_alias],
        [Stat("avg", value, avg_a)],
        keep_raw=[avg_a],
        derived={period_alias: period_start_sql(q(ts), period)},
        then=then,
    )


def _period_over_period_via_day(df, keys, ts, period, value, period_alias, change_alias, day):
    m = moments_of(df, value)
    buffers = m.mean_buffers()
    avg_a = f"avg_{value}"
    mean = m.mean()
    part = ", ".join(q(k) for k in keys)

    def finish(g: DataFrame) -> DataFrame:
        per = g.selectExpr(*[q(k) for k in keys], f"{period_start_sql(q(day), period)} AS {q(period_alias)}",
                           *[q(b) for b in buffers])
        # Exact integer sums and counts merge without error.
        per = per.groupBy(*keys, period_alias).agg(*[F.expr(f"{merged(b, t)} AS {q(b)}") for b, t in buffers.items()])
        lag = f"LAG({mean}, 1) OVER (PARTITION BY {part} ORDER BY {q(period_alias)} ASC NULLS LAST)"
        out = per.selectExpr(
            *[q(k) for k in keys],
            q(period_alias),
            f"{round_sql(mean, 2)} AS {q(avg_a)}",
            f"{round_sql(f'{mean} - {lag}', 2)} AS {q(change_alias)}",
        )
        return out.orderBy(*asc(*keys, period_alias))

    return AggSpec((*keys, day), buffers, finish, {**m.mean_derived(), day: period_start_sql(q(ts), "day")})


def period_over_period(df: DataFrame, keys: Sequence[str], ts: str, period: str, value: str, **kw) -> DataFrame:
    """Per group and period: rounded mean and its change from the previous
    period *present* in the group (NULL for the first), from unrounded means.

    The lag window is partitioned by the group keys over the aggregate, so it
    sees one row per period.
    """
    return run_spec(df, period_over_period_spec(df, keys, ts, period, value, **kw))
