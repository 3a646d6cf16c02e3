"""Share operators: how a group's rows split over categories or bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cirrus.functions.expr import band_sql, q, round_sql
from cirrus.operators.aggregates import AggSpec, Stat, asc, desc, raw_name, run_spec, stats_spec


def category_share_spec(
    df: DataFrame,
    keys: Sequence[str],
    category: str,
    count_alias: str = "occurrences",
    share_alias: str = "percentage",
    derived: dict[str, str] | None = None,
) -> AggSpec:
    part = ", ".join(q(k) for k in keys)

    def then(g: DataFrame) -> DataFrame:
        # The total is a window over the aggregated counts: one row per
        # (keys, category) reaches that shuffle, never the raw rows.
        n = q(count_alias)
        share = round_sql(f"CAST({n} AS DOUBLE) * 100D / CAST(SUM({n}) OVER (PARTITION BY {part}) AS DOUBLE)", 2)
        out = g.selectExpr(*[q(k) for k in keys], q(category), n, f"{share} AS {q(share_alias)}")
        return out.orderBy(*asc(*keys), *desc(count_alias))

    return stats_spec(df, [*keys, category], [Stat("count", None, count_alias)], derived=derived, then=then)


def category_share(df: DataFrame, keys: Sequence[str], category: str, **kw) -> DataFrame:
    """Per (keys, category): row count and its percentage of the keys' total."""
    return run_spec(df, category_share_spec(df, keys, category, **kw))


def banded_share_spec(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    bands: Sequence[tuple[float, str]],
    otherwise: str,
    band_alias: str,
    **kw,
) -> AggSpec:
    return category_share_spec(df, keys, band_alias, derived={band_alias: band_sql(q(value), bands, otherwise)}, **kw)


def banded_share(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    bands: Sequence[tuple[float, str]],
    otherwise: str,
    band_alias: str,
    **kw,
) -> DataFrame:
    """``category_share`` over a band of ``value`` (NULL falls to ``otherwise``)."""
    return run_spec(df, banded_share_spec(df, keys, value, bands, otherwise, band_alias, **kw))


def grouped_band_spec(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    bands: Sequence[tuple[float, str]],
    otherwise: str,
    having_below: float | None,
    band_alias: str,
    count_alias: str = "occurrences",
) -> AggSpec:
    avg_a, min_a = f"avg_{value}", f"min_{value}"
    stats = [Stat("avg", value, avg_a), Stat("min", value, min_a), Stat("count", None, count_alias)]
    raw = q(raw_name(avg_a))

    def then(g: DataFrame) -> DataFrame:
        if having_below is not None:
            g = g.where(f"{raw} < {having_below}")
        out = g.selectExpr(
            *[q(k) for k in keys], q(avg_a), q(min_a), q(count_alias), f"{band_sql(raw, bands, otherwise)} AS {q(band_alias)}"
        )
        return out.orderBy(*asc(avg_a))

    return stats_spec(df, keys, stats, keep_raw=[avg_a], then=then)


def grouped_band(df: DataFrame, keys: Sequence[str], value: str, *args, **kw) -> DataFrame:
    """Per group: mean and min of ``value``, count, and a band of the mean.

    Groups whose (unrounded) mean is not below ``having_below`` are dropped;
    bands also use the unrounded mean.  Ordered by the rounded mean.
    """
    return run_spec(df, grouped_band_spec(df, keys, value, *args, **kw))
