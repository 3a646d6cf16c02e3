"""The sixteen named weather queries, as presets of the generic operators.

Each takes a readings frame (``cirrus.schema.READINGS_SCHEMA`` columns) and
returns a lazy DataFrame with the documented columns, in the documented
order.  Means, variances and correlations come from exact sums.

Fifteen of the sixteen are single aggregates; ``SPECS`` gives them as
``AggSpec``s so that ``fused_queries`` can compute all of them in one
GROUPING SETS pass (one scan, one shuffle), plus one more pass for the
anomaly join.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame

from cirrus import schema as S
from cirrus.operators.aggregates import AggSpec, run_spec, run_specs_fused
from cirrus.operators.freshness import freshness_spec
from cirrus.operators.outliers import group_moments_spec, grouped_correlation_spec, zscore_outliers
from cirrus.operators.profiles import grouped_profile_spec, hour_of_day_spec, paired_gap_spec, period_profile_spec
from cirrus.operators.ranking import (
    mapped_rollup_rank_spec,
    period_over_period_spec,
    rank_groups_spec,
    volatility_rank_spec,
)
from cirrus.operators.shares import banded_share_spec, category_share_spec, grouped_band_spec

CITY_COUNTRY = [S.CITY, S.COUNTRY]
TS = S.RECORDED_AT


def _specs(as_of: dt.datetime | str | None = None, fused: bool = False) -> dict[str, Callable[[DataFrame], AggSpec]]:
    """Specs of the aggregate queries.  ``fused``: the monthly trend and the
    continent ranking are served from grouping sets other queries need
    anyway (rolled up in their finishing steps); on their own they group
    directly."""
    return {
        "avg_temperature_per_city": lambda r: grouped_profile_spec(r, CITY_COUNTRY, S.TEMPERATURE),
        "hottest_coldest_ranking": lambda r: rank_groups_spec(r, CITY_COUNTRY, S.TEMPERATURE),
        "humidity_trends": lambda r: period_profile_spec(r, [S.CITY], TS, "day", S.HUMIDITY),
        "wind_speed_distribution": lambda r: banded_share_spec(
            r, [S.CITY], S.WIND_SPEED, S.WIND_BANDS, S.WIND_ELSE, "wind_category"
        ),
        "weather_condition_frequency": lambda r: category_share_spec(r, [S.CITY], S.DESCRIPTION),
        "temperature_humidity_correlation": lambda r: grouped_correlation_spec(
            r, [S.CITY], S.TEMPERATURE, S.HUMIDITY, "temp_humidity_correlation"
        ),
        "daily_temperature_range": lambda r: period_profile_spec(
            r, [S.CITY], TS, "day", S.TEMPERATURE, label="temp", stats=("min", "max", "range", "avg")
        ),
        "pressure_trends": lambda r: period_profile_spec(
            r, [S.CITY], TS, "day", S.PRESSURE, stats=("avg", "min", "max", "range")
        ),
        "feels_like_gap": lambda r: paired_gap_spec(r, [S.CITY], S.TEMPERATURE, S.FEELS_LIKE),
        "visibility_impact": lambda r: grouped_band_spec(
            r,
            [S.CITY, S.DESCRIPTION],
            S.VISIBILITY,
            S.VISIBILITY_BANDS,
            S.VISIBILITY_ELSE,
            S.VISIBILITY_HAVING_BELOW,
            "visibility_category",
        ),
        "hourly_weather_pattern": lambda r: hour_of_day_spec(r, TS, [S.TEMPERATURE, S.HUMIDITY, S.WIND_SPEED]),
        "data_freshness_per_city": lambda r: freshness_spec(
            r, [S.CITY], TS, as_of, S.FRESHNESS_DELAYED_HOURS, S.FRESHNESS_STALE_HOURS
        ),
        # Rolled up from the (city, day) set the daily profiles use.
        "monthly_temperature_trend": lambda r: period_over_period_spec(
            r, [S.CITY], TS, "month", S.TEMPERATURE, via_day="date" if fused else None
        ),
        # Rolled up from the (city, country) set of the per-city profiles.
        "continent_temperature_ranking": lambda r: mapped_rollup_rank_spec(
            r, S.CITY, S.CONTINENT_OF_CITY, S.CONTINENT_ELSE, S.TEMPERATURE, "continent",
            distinct_alias="city_count", via_keys=CITY_COUNTRY if fused else None,
        ),
        "temperature_volatility_by_city": lambda r: volatility_rank_spec(r, CITY_COUNTRY, S.TEMPERATURE),
    }


SPECS = _specs()


def _direct(name: str) -> Callable[[DataFrame], DataFrame]:
    def run(r: DataFrame) -> DataFrame:
        return run_spec(r, SPECS[name](r))

    run.__name__ = name
    return run


avg_temperature_per_city = _direct("avg_temperature_per_city")
hottest_coldest_ranking = _direct("hottest_coldest_ranking")
humidity_trends = _direct("humidity_trends")
wind_speed_distribution = _direct("wind_speed_distribution")
weather_condition_frequency = _direct("weather_condition_frequency")
temperature_humidity_correlation = _direct("temperature_humidity_correlation")
daily_temperature_range = _direct("daily_temperature_range")
pressure_trends = _direct("pressure_trends")
feels_like_gap = _direct("feels_like_gap")
visibility_impact = _direct("visibility_impact")
hourly_weather_pattern = _direct("hourly_weather_pattern")
monthly_temperature_trend = _direct("monthly_temperature_trend")
continent_temperature_ranking = _direct("continent_temperature_ranking")
temperature_volatility_by_city = _direct("temperature_volatility_by_city")


def anomaly_detection(r: DataFrame, std_threshold: float = 2.0, moments: DataFrame | None = None) -> DataFrame:
    return zscore_outliers(r, [S.CITY], S.TEMPERATURE, TS, std_threshold, 50, moments=moments)


def data_freshness_per_city(r: DataFrame, as_of: dt.datetime | str | None = None) -> DataFrame:
    return run_spec(r, _specs(as_of)["data_freshness_per_city"](r))


# Suite order.
QUERIES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "avg_temperature_per_city": avg_temperature_per_city,
    "hottest_coldest_ranking": hottest_coldest_ranking,
    "humidity_trends": humidity_trends,
    "wind_speed_distribution": wind_speed_distribution,
    "weather_condition_frequency": weather_condition_frequency,
    "temperature_humidity_correlation": temperature_humidity_correlation,
    "daily_temperature_range": daily_temperature_range,
    "anomaly_detection": anomaly_detection,
    "pressure_trends": pressure_trends,
    "feels_like_gap": feels_like_gap,
    "visibility_impact": visibility_impact,
    "hourly_weather_pattern": hourly_weather_pattern,
    "data_freshness_per_city": data_freshness_per_city,
    "monthly_temperature_trend": monthly_temperature_trend,
    "continent_temperature_ranking": continent_temperature_ranking,
    "temperature_volatility_by_city": temperature_volatility_by_city,
}

_MOMENTS = "__city_moments"


def fused_queries(
    r: DataFrame,
    as_of: dt.datetime | str | None = None,
    std_threshold: float = 2.0,
    extra: dict[str, AggSpec] | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """All sixteen results from two passes over ``r``.

    Pass 1: one GROUPING SETS aggregate for the fifteen aggregate queries
    and the per-city moments of the anomaly query (checkpointed; as many rows
    as the results together).  Pass 2: the anomaly join of the readings with
    those moments.  Returns the results in suite order and the shared
    aggregate.  ``extra`` specs (e.g. the quality
    report) ride along in the same pass; their results follow the queries.
    """
    builders = _specs(as_of, fused=True)
    specs = {name: b(r) for name, b in builders.items()}
    specs[_MOMENTS] = group_moments_spec(r, [S.CITY], S.TEMPERATURE)
    specs.update(extra or {})
    results, shared = run_specs_fused(r, specs)
    results["anomaly_detection"] = anomaly_detection(r, std_threshold, moments=results.pop(_MOMENTS))
    return {name: results[name] for name in [*QUERIES, *(extra or {})]}, shared
