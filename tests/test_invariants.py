"""Invariants of every query on seeded sample readings (the reference's own
query tests check shapes and invariants like these on generated data)."""

import datetime as dt
import math

import pytest

from cirrus import schema as S
from cirrus.plans import weather as W
from cirrus.sources.sample import generate_readings

BASE = dt.datetime(2026, 3, 1, 12, 0)
HOURS = 48


@pytest.fixture(scope="module")
def sample(spark):
    return generate_readings(spark, hours=HOURS, base_time=BASE, seed=11).persist()


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_one_row_per_city(sample):
    out = rows(W.avg_temperature_per_city(sample))
    assert len(out) == 12 and sum(r["record_count"] for r in out) == 12 * HOURS
    assert all(r["min_temperature"] <= r["avg_temperature"] <= r["max_temperature"] for r in out)
    assert [r["avg_temperature"] for r in out] == sorted((r["avg_temperature"] for r in out), reverse=True)


def test_rankings_start_at_one_and_mirror(sample):
    out = rows(W.hottest_coldest_ranking(sample))
    assert min(r["hottest_rank"] for r in out) == 1 and min(r["coldest_rank"] for r in out) == 1
    assert all(r["hottest_rank"] + r["coldest_rank"] == 13 for r in out)
    top = [r for r in out if r["hottest_rank"] == 1][0]
    assert top["avg_temperature"] == max(r["avg_temperature"] for r in out)


def test_daily_profiles(sample):
    for q, lo, hi in ((W.humidity_trends, "min_humidity", "max_humidity"),
                      (W.daily_temperature_range, "min_temp", "max_temp"),
                      (W.pressure_trends, "min_pressure", "max_pressure")):
        out = rows(q(sample))
        assert all(r[lo] <= r[hi] for r in out)
        assert all(r["date"].hour == 0 and r["date"].minute == 0 for r in out)
    assert all(r["temp_range"] >= 0 for r in rows(W.daily_temperature_range(sample)))
    assert all(r["pressure_range"] >= 0 for r in rows(W.pressure_trends(sample)))


def test_shares(sample):
    for q, col, allowed in ((W.wind_speed_distribution, "wind_category", {"Calm", "Light Breeze", "Moderate", "Strong"}),
                            (W.weather_condition_frequency, "weather_description", set(S.SAMPLE_DESCRIPTIONS))):
        out = rows(q(sample))
        assert {r[col] for r in out} <= allowed
        for city in {r["city"] for r in out}:
            part = [r for r in out if r["city"] == city]
            assert sum(r["occurrences"] for r in part) == HOURS
            assert abs(sum(r["percentage"] for r in part) - 100) < 0.05


def test_correlation_bounds(sample):
    out = rows(W.temperature_humidity_correlation(sample))
    assert len(out) == 12 and all(-1 <= r["temp_humidity_correlation"] <= 1 for r in out)


def test_anomalies(sample):
    out = rows(W.anomaly_detection(sample, std_threshold=1.5))
    assert len(out) <= 50 and all(r["is_anomaly"] for r in out)
    assert all(r["z_score"] >= 1.5 - 0.01 for r in out)
    assert [r["z_score"] for r in out] == sorted((r["z_score"] for r in out), reverse=True)


def test_gap_visibility_hours_freshness(sample):
    gap = rows(W.feels_like_gap(sample))
    assert all(r["min_gap"] <= r["avg_gap"] <= r["max_gap"] for r in gap)
    vis = rows(W.visibility_impact(sample))
    assert all(r["avg_visibility"] < 10000 and r["visibility_category"] in {"Severe", "Reduced", "Clear"} for r in vis)
    hours = rows(W.hourly_weather_pattern(sample))
    assert [r["hour_of_day"] for r in hours] == list(range(24)) and sum(r["record_count"] for r in hours) == 12 * HOURS
    fresh = rows(W.data_freshness_per_city(sample, BASE + dt.timedelta(hours=30)))
    assert {r["freshness_status"] for r in fresh} == {"Stale"} and all(r["hours_since_last_record"] == 30 for r in fresh)
    fresh = rows(W.data_freshness_per_city(sample, BASE))
    assert {r["freshness_status"] for r in fresh} == {"Fresh"}


def test_monthly_continents_volatility(sample):
    months = rows(W.monthly_temperature_trend(sample))
    firsts = {}
    for r in months:
        firsts.setdefault(r["city"], r)
    assert all(r["change_from_previous_month"] is None for r in firsts.values())
    cont = rows(W.continent_temperature_ranking(sample))
    assert sum(r["total_readings"] for r in cont) == 12 * HOURS and sum(r["city_count"] for r in cont) == 12
    assert min(r["temperature_rank"] for r in cont) == 1
    vol = rows(W.temperature_volatility_by_city(sample))
    top = [r for r in vol if r["volatility_rank"] == 1][0]
    assert top["temperature_stddev"] == max(r["temperature_stddev"] for r in vol)
    assert all(not math.isnan(r["temperature_stddev"]) for r in vol)
