"""Profile operators: per-group summaries of one or more value columns.

Each operator has a ``*_spec`` form (an ``AggSpec``, usable in a fused
suite) and a direct form that runs the spec on its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cirrus.functions.expr import hour_of_day_sql, period_start_sql, q
from cirrus.operators.aggregates import AggSpec, Stat, asc, desc, run_spec, stats_spec


def grouped_profile_spec(
    df: DataFrame, keys: Sequence[str], value: str, count_alias: str = "record_count"
) -> AggSpec:
    stats = [
        Stat("avg", value, f"avg_{value}"),
        Stat("min", value, f"min_{value}"),
        Stat("max", value, f"max_{value}"),
        Stat("stddev_samp", value, f"{value}_stddev"),
        Stat("count", None, count_alias),
    ]
    return stats_spec(df, keys, stats, then=lambda g: g.orderBy(*desc(f"avg_{value}")))


def grouped_profile(
    df: DataFrame, keys: Sequence[str], value: str, count_alias: str = "record_count"
) -> DataFrame:
    """Per group: mean, min, max and sample stddev of ``value``, and a count.

    Outputs ``avg_<v>, min_<v>, max_<v>, <v>_stddev, <count_alias>``, ordered
    by the rounded mean, highest first.
    """
    return run_spec(df, grouped_profile_spec(df, keys, value, count_alias))


_PERIOD_STATS = {"avg": "avg_{}", "min": "min_{}", "max": "max_{}", "range": "{}_range"}


def period_profile_spec(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    period: str,
    value: str,
    label: str | None = None,
    stats: Sequence[str] = ("avg", "min", "max"),
    period_alias: str = "date",
) -> AggSpec:
    label = label or value
    spec = [Stat(k, value, _PERIOD_STATS[k].format(label)) for k in stats]
    return stats_spec(
        df,
        [*keys, period_alias],
        spec,
        derived={period_alias: period_start_sql(q(ts), period)},
        then=lambda g: g.orderBy(*asc(*keys), *desc(period_alias)),
    )


def period_profile(df: DataFrame, keys: Sequence[str], ts: str, period: str, value: str, **kw) -> DataFrame:
    """Per group and calendar period (day/month/hour) of ``ts``.

    ``stats`` picks and orders the outputs among avg, min, max and range
    (max - min); they are named ``avg_<label>``, ``min_<label>``,
    ``max_<label>``, ``<label>_range``.  Ordered by keys ascending, period
    newest first.
    """
    return run_spec(df, period_profile_spec(df, keys, ts, period, value, **kw))


def paired_gap_spec(
    df: DataFrame,
    keys: Sequence[str],
    actual: str,
    perceived: str,
    names: Sequence[str] = ("avg_actual_temp", "avg_feels_like", "avg_gap", "min_gap", "max_gap"),
) -> AggSpec:
    a_avg, p_avg, g_avg, g_min, g_max = names
    gap = f"__gap_{perceived}_{actual}"
    stats = [
        Stat("avg", actual, a_avg),
        Stat("avg", perceived, p_avg),
        Stat("avg", gap, g_avg),
        Stat("min", gap, g_min),
        Stat("max", gap, g_max),
    ]
    return stats_spec(
        df,
        keys,
        stats,
        derived={gap: f"({q(perceived)} - {q(actual)})"},
        then=lambda g: g.orderBy(*desc(g_avg)),
    )


def paired_gap(df: DataFrame, keys: Sequence[str], actual: str, perceived: str, **kw) -> DataFrame:
    """Per group: mean of both columns and mean/min/max of ``perceived - actual``.

    The difference is a row-level expression aggregated in the same pass.
    """
    return run_spec(df, paired_gap_spec(df, keys, actual, perceived, **kw))


def hour_of_day_spec(
    df: DataFrame,
    ts: str,
    values: Sequence[str],
    hour_alias: str = "hour_of_day",
    count_alias: str = "record_count",
) -> AggSpec:
    stats = [Stat("avg", v, f"avg_{v}") for v in values] + [Stat("count", None, count_alias)]
    return stats_spec(
        df,
        [hour_alias],
        stats,
        derived={hour_alias: hour_of_day_sql(q(ts))},
        then=lambda g: g.orderBy(*asc(hour_alias)),
    )


def hour_of_day_profile(df: DataFrame, ts: str, values: Sequence[str], **kw) -> DataFrame:
    """Across all groups, per hour of day: rounded mean of each value, count."""
    return run_spec(df, hour_of_day_spec(df, ts, values, **kw))
